"""Token ids as flat binary files with document offsets, in key order.

Layout of one part (all little-endian): ``.tokens`` holds the ids of its documents one
after the other, as unsigned 16-bit integers if the vocabulary allows and as
32-bit ones otherwise; ``.offsets`` holds one unsigned 64-bit number more than it
has documents, the place of each document's first id and the end; ``.keys`` holds the documents'
keys as signed 64-bit integers. Parts are ranges of the key in ascending order. The manifest has one
row per part; the ids before a part (its base) are a prefix sum over the manifest.

Documents are range-partitioned and sorted by key, so that no task sees more
than its range; each task streams its documents to its own files. A task that is
run again writes new files, and the manifest, written with the job's results,
names only those of the attempt that counted. Files go to a folder all
executors share and are memory-mapped for reading where it is a mounted one.

Ids come from the tokenizers library. A text is cut at white space, which the
vocabulary drops, and each word is encoded once and remembered by the worker, within
two generations of ``REMEMBERED`` words.

Defined results: a NULL text is the empty one and has only the end id; a NULL
key is written as the smallest 64-bit integer, comes first and reads back as
NULL; of equal keys the order follows the text; an empty table gives no
part and no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.bpe import printable_bytes
from tidemart.llm.common import map_batches, narrow, saved, shuffle_partitions, text_chunks
from tidemart.session import scratch_dir

END_ID = 2
CHUNK_CHARS = 1 << 22
REMEMBERED = 500_000
NULL_KEY = -(1 << 63)
MANIFEST = "part int, dtype string, tokens string, offsets string, keys string, n_docs long, n_tokens long"
# Fixed value: the vocabulary's pre-token pattern.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")


ASCII_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class WordEncoder:
    """Ids of texts from a vocabulary that drops white space, lower-cases and marks word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.marks = {t.lower()[:2] for t in self.special}
        self.letters = str.maketrans({byte: char for char, byte in printable_bytes().items()})
        self.now: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def pre_tokens(self, word: bytes) -> list[str]:
        """Pre-tokens of a word, their bytes written as the vocabulary writes them."""
        if word.isalpha():  # of ASCII
            return [word.decode()]
        text = word.decode()
        if text.isascii():
            pieces = ASCII_PATTERN.findall(text)
        else:
            pieces = PATTERN.findall(self.library.normalizer.normalize_str(text))
        return [p.encode().decode("latin-1").translate(self.letters) for p in pieces]

    def learn(self, words: list[bytes]) -> None:
        """Remember the ids of words."""
        tokenize, kind = self.library.model.tokenize, self.dtype.char
        for word in words:
            if word in self.before:
                self.now[word] = self.before[word]
            else:
                ids = [t.id for p in self.pre_tokens(word) for t in tokenize(p)]
                self.now[word] = struct.pack(f"<{len(ids)}{kind}", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as the bytes of a flat array."""
        # Only A-Z are lower-cased here, which commutes with what the library does first.
        lowered = [t.encode().lower() for t in texts]
        out = []
        for text, low in zip(texts, lowered):
            if any(m in low for m in self.marks):
                out.append(self.whole(text))
                continue
            words, now = low.split(), self.now
            self.learn([w for w in words if w not in now])
            out.append(b"".join(map(now.__getitem__, words)))
            if len(now) > REMEMBERED:
                self.now, self.before = {}, now
        return out


@lru_cache(maxsize=2)
def load(path: str) -> WordEncoder:
    return WordEncoder(path)


def _filesystem(location: str) -> tuple[pafs.FileSystem, str]:
    if urlparse(location).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlparse(location).path
    return pafs.FileSystem.from_uri(location)


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encode all documents into parts under ``folder``; the manifest, saved."""
    spark = docs.sparkSession
    rows = narrow(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("doc_id"), "text")
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        part = TaskContext.get().partitionId()
        files, base = None, ""
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        n_docs = place = 0
        for batch in batches:
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                if files is None:
                    system, root = _filesystem(folder)
                    system.create_dir(root, recursive=True)
                    base = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
                    local = _filesystem(base)[1]
                    files = [system.open_output_stream(f"{local}.{kind}") for kind in ("tokens", "offsets", "keys")]
                data = [ids + end for ids in encoder.encode(texts)]
                counts = np.array([len(d) // encoder.dtype.itemsize for d in data], dtype=np.uint64)
                ends = np.cumsum(counts) + np.uint64(place)
                files[0].write(b"".join(data))
                files[1].write((ends - counts).astype("<u8").tobytes())
                files[2].write(batch.column("doc_id").slice(first, len(texts)).to_numpy().astype("<i8").tobytes())
                place, n_docs = int(ends[-1]), n_docs + len(texts)
        if files is not None:
            files[1].write(np.array([place], dtype="<u8").tobytes())
            for file in files:
                file.close()
            names = [[f"{base}.{kind}"] for kind in ("tokens", "offsets", "keys")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([encoder.dtype.str]),
                    *map(pa.array, names),
                    pa.array([n_docs], pa.int64()),
                    pa.array([place], pa.int64()),
                ],
                names=["part", "dtype", "tokens", "offsets", "keys", "n_docs", "n_tokens"],
            )

    return saved(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with the ids before each part; one row per file, so one window is small."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))


def _mapped(location: str, dtype: str) -> np.ndarray:
    system, path = _filesystem(location)
    if isinstance(system, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype=dtype)


def read_documents(manifest: DataFrame, digest, schema: str, block: int = 4096) -> DataFrame:
    """Documents from the files: (doc_id, start, n_tokens) and what ``digest`` makes of each one's ids.

    ``digest`` takes a list of id arrays and returns columns by name, described by ``schema``.
    """
    spark = manifest.sparkSession
    parts = with_bases(manifest).repartition(max(1, shuffle_partitions(spark)))

    def make():
        def step(batch: pa.RecordBatch):
            for row in batch.to_pylist():
                tokens = _mapped(row["tokens"], row["dtype"])
                offsets, keys = _mapped(row["offsets"], "<u8"), _mapped(row["keys"], "<i8")
                for start in range(0, row["n_docs"], block):
                    stop = min(start + block, row["n_docs"])
                    places = np.asarray(offsets[start : stop + 1]).astype(np.int64)
                    ids = [tokens[a:b] for a, b in zip(places, places[1:])]
                    yield {
                        "doc_id": [None if k == NULL_KEY else k for k in keys[start:stop].tolist()],
                        "start": row["base"] + places[:-1],
                        "n_tokens": np.diff(places),
                        **digest(ids),
                    }

        return step

    return map_batches(parts, make, f"doc_id long, start long, n_tokens long, {schema}")


def checksums(ids: list[np.ndarray]) -> dict:
    """crc32 of each document's ids as little-endian unsigned 32-bit integers."""
    return {"ids_crc32": [zlib.crc32(np.asarray(i).astype("<u4").tobytes()) for i in ids]}


def round_trip(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) as read back from the written files."""
    folder = scratch_dir(docs.sparkSession, "token-files")
    return read_documents(write_token_files(docs, path, folder, end_id), checksums, "ids_crc32 long")
