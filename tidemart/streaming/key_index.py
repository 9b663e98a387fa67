"""Which stored keys a batch may repeat: keys by bucket, each file behind a Bloom filter.

Beside a keyed table stands an index: its keys alone, in one folder per stream, batch and bucket of the
key's hash, and a Bloom filter of every such folder. A batch's keys meet the filters of their
buckets; only folders with a key that may be stored are read, and those are matched
exactly. A batch of new keys reads the filters (``BITS_PER_KEY`` bits a key) and next to none of the
keys, whatever the table holds.

The index of a batch is written after its rows, under the same stream and batch, so a replay writes both
again. Batches that are in the table but not in the index (after a crash between the two writes, in a
compacted copy, in a table from before it had an index) are indexed from their rows before the next check.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.sources.tables import read_table_or_empty

LINEAGE = ["stream_id", "batch_id"]
LINEAGE_SCHEMA = "stream_id STRING, batch_id BIGINT"
# A key that is not stored passes a filter once in about 120 times.
BITS_PER_KEY = 10
PROBES = 5
WORD_BITS = 64
FILTER_SCHEMA = f"bucket INT, n_keys BIGINT, bits BIGINT, words ARRAY<STRUCT<word: INT, bits: BIGINT>>, {LINEAGE_SCHEMA}"


def key_hash(key: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), key)


@dataclass(frozen=True)
class KeyIndex:
    """The index of a table of ``key`` at ``path``; a bucket's filters are looked through in one task."""

    path: str
    key: str
    buckets: int = 32

    @property
    def keys_path(self) -> str:
        return f"{self.path}/keys"

    def bucket(self) -> Column:
        return F.pmod(key_hash(F.col(self.key), 0), F.lit(self.buckets)).cast("int")

    def keys(self, spark: SparkSession) -> DataFrame:
        return read_table_or_empty(spark, self.keys_path, f"{self.key} STRING, {LINEAGE_SCHEMA}, bucket INT")

    def filters(self, spark: SparkSession) -> DataFrame:
        return read_table_or_empty(spark, f"{self.path}/filters", FILTER_SCHEMA)

    def add(self, rows: DataFrame) -> None:
        """Index rows (key, stream_id, batch_id), replacing what the index holds of these batches' buckets."""
        place = [*LINEAGE, "bucket"]
        batches = [tuple(r) for r in rows.select(*LINEAGE).distinct().collect()]
        if not batches:
            return
        keyed = rows.select(F.col(self.key).cast("string"), *LINEAGE).withColumn("bucket", self.bucket())
        _overwrite(keyed.repartition(*place), place, self.keys_path)
        written = self.keys(rows.sparkSession).where(_one_of(LINEAGE, batches))
        _overwrite(bloom_filters(written, self.key).repartition(*LINEAGE), LINEAGE, f"{self.path}/filters")

    def complete(self, table: DataFrame) -> None:
        """Index the batches of the table (with lineage columns) that the index lacks, by the names of the files alone."""
        missing = batches_of(table) - batches_of(self.filters(table.sparkSession))
        if missing:
            self.add(table.where(_one_of(LINEAGE, missing)).select(self.key, *LINEAGE))

    def possible(self, batch: DataFrame, replaced: Column) -> DataFrame:
        """The stored keys of all folders that may hold a key of the batch, except the ``replaced`` ones."""
        spark = batch.sparkSession
        stored = self.filters(spark).where(~replaced)
        if stored.isEmpty():
            # Nothing to probe, so the batch's keys need not go through the filters.
            return self.keys(spark).where(F.lit(False)).select(self.key)
        hits = probed(stored, batch, self.key, self.bucket())
        # One row per folder with a hit; a batch of new keys has few.
        place = [*LINEAGE, "bucket"]
        folders = [tuple(r) for r in hits.select(*place).distinct().collect()]
        return self.keys(spark).where(_one_of(place, folders)).select(self.key)


def batches_of(table: DataFrame) -> set[tuple[str, int]]:
    """The (stream_id, batch_id) of all files of a partitioned table."""
    found = (re.search(r"/stream_id=([^/]*)/batch_id=([^/]*)/", f) for f in table.inputFiles())
    return {(unquote(m[1]), int(m[2])) for m in found if m}


def _one_of(names: list[str], values: Iterable[tuple]) -> Column:
    """A filter on partition columns, settled when folders are listed."""
    return F.concat_ws("/", *[F.col(n).cast("string") for n in names]).isin(["/".join(map(str, v)) for v in values])


def _overwrite(rows: DataFrame, partitions: list[str], path: str) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def bloom_filters(keys: DataFrame, key: str) -> DataFrame:
    """One filter for each stream, batch and bucket, sized by its keys: the words that have a bit set."""
    place = [*LINEAGE, "bucket"]
    sizes = keys.groupBy(*place).agg(F.count("*").alias("n_keys"))
    bits = (F.ceil(F.col("n_keys") * BITS_PER_KEY / WORD_BITS) * WORD_BITS).cast("bigint")
    seeds = F.array(*[key_hash(F.col(key), i + 1) for i in range(PROBES)])
    # One row per folder, so the sizes are small beside the keys.
    placed = keys.join(sizes.withColumn("bits", bits), place).select(*place, "n_keys", "bits", F.explode(seeds).alias("seed"))
    at = placed.withColumn("at", F.pmod("seed", "bits"))
    words = at.groupBy(*place, "n_keys", "bits", F.floor(F.col("at") / WORD_BITS).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % WORD_BITS).cast("int"))).alias("set")
    )
    return words.groupBy(*place, "n_keys", "bits").agg(
        F.collect_list(F.struct("word", F.col("set").alias("bits"))).alias("words")
    ).select("bucket", "n_keys", "bits", "words", *LINEAGE)


def probed(filters: DataFrame, batch: DataFrame, key: str, bucket: Column) -> DataFrame:
    """(key, stream_id, batch_id, bucket): keys of the batch with each folder whose filter holds them."""
    names_of_seeds = [f"__seed_{i + 1}" for i in range(PROBES)]
    seeds = [key_hash(F.col(key), i + 1).alias(name) for i, name in enumerate(names_of_seeds)]
    asked = batch.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(key), bucket.alias("bucket"), *seeds)

    def probe(stored: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, list] = {c: [] for c in (key, *LINEAGE, "bucket")}
        if len(stored) and len(keys):
            names, seeds = keys[key].to_numpy(dtype=object), keys[names_of_seeds].to_numpy()
            for row in stored.itertuples(index=False):
                table = np.zeros(row.bits // WORD_BITS, dtype=np.int64)
                for word in row.words:
                    table[word["word"]] = word["bits"]
                at = np.mod(seeds, row.bits)
                held = names[((table[at // WORD_BITS] >> (at % WORD_BITS)) & 1 == 1).all(axis=1)]
                for c, v in zip(found, (held, *[[x] * len(held) for x in (row.stream_id, row.batch_id, row.bucket)])):
                    found[c] += list(v)
        return pd.DataFrame({c: np.array(v, dtype=object) for c, v in found.items()})

    grouped = filters.groupBy("bucket").cogroup(asked.groupBy("bucket"))
    return grouped.applyInPandas(probe, f"{key} STRING, {LINEAGE_SCHEMA}, bucket INT")
