"""Mixing sources to target weights by systematic sampling.

Every step is a DataFrame expression. A document's expected number of copies is
``target / size`` of its source. The copies are laid end to end within the
source and one random offset decides which integer boundaries are crossed:

    copies = floor(offset + expected up to and with me) - floor(offset + expected before me)

so a source's number of copies is within one of what is expected, and a document
appears ``floor`` or ``ceil`` of its expectation. Documents are laid out by size
class first, so that large and small documents are both met in proportion and
the words taken come near the target too.

The prefix sum has three levels: size classes of a source (a few dozen), lanes
of a class (256, by a digest of the key), rows of a lane. No window covers a
whole source, so a source with a third of all rows is spread over thousands of
windows, and only narrow rows are shuffled.

Defined results: NULL text has size 0; a NULL source is a source of its own,
ordered last; a document of size 0 takes no words; with no words at all every
target is 0; repeated rows are separate documents; an empty table gives an
empty result. Extra columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import WORD

CAP = 3
WEIGHTS = (1, 2, 3)
# Size classes per doubling: sizes within a class differ by about 9%.
CLASSES_PER_OCTAVE = 8
OFFSET_STEPS = 1 << 20


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    return F.when(size > 0, F.floor(F.log2(size.cast("double")) * CLASSES_PER_OCTAVE)).otherwise(-1).cast("int")


def source_targets(sizes: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, n_docs, source_size, target) from rows of (source, size).

    Sources in code point order take the weights in turn. Targets share the sum
    of all sizes in proportion to weight, no target above ``cap`` times its
    source's size: with sources in order of ``cap * size / weight``, a source
    stops at its cap exactly if filling all to its own level would need less
    than there is to share. The windows here are over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = (
        per_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
        .withColumn("ratio", (F.lit(cap) * F.col("source_size")).cast("double") / F.col("weight"))
        .withColumn("all_sizes", F.sum("source_size").over(everything))
        .withColumn("full", F.lit(cap) * F.sum("source_size").over(level.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("open_weight", F.coalesce(F.sum("weight").over(level.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)))
        .withColumn("capped", F.col("full") + F.col("ratio") * F.col("open_weight") < F.col("all_sizes"))
    )
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    full = F.coalesce(F.sum(F.when(F.col("capped"), F.lit(cap) * F.col("source_size"))).over(everything), F.lit(0))
    rest = (F.col("all_sizes") - full).cast("double") / open_weight
    return ranked.select(
        "source",
        "n_docs",
        "source_size",
        F.when(F.col("capped"), (F.lit(cap) * F.col("source_size")).cast("double"))
        .otherwise(F.least(rest * F.col("weight"), (F.lit(cap) * F.col("source_size")).cast("double")))
        .alias("target"),
    )


def mix_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    cap: int = CAP,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = 7,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), one row per document."""
    sized = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{source_column}`").alias("source"),
        n_words(F.col(f"`{text_column}`")).alias("size"),
    )
    return _sampled(sized, cap, weights, seed).select("doc_id", "source", "size", "source_size", "target", "copies")


def _sampled(sized: DataFrame, cap: int, weights: tuple[int, ...], seed: int) -> DataFrame:
    """Rows with (doc_id, source, size) and any other columns, with ``source_size``, ``target`` and ``copies``.

    Counts and bases come from the three columns alone; the rows themselves are shuffled once, to their lane.
    """
    named = {
        "size_class": size_class(F.col("size")),
        "lane": F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 2),
        # A NULL source as a key of its own, so that joins and windows share one partitioning.
        "source_name": F.coalesce("source", F.lit("")),
        "source_known": F.col("source").isNotNull(),
    }
    laid = sized.withColumns(named)
    of_source = ["source_name", "source_known"]
    of_class = [*of_source, "size_class"]
    place = [*of_class, "lane"]
    targets = source_targets(sized.select("source", "size"), cap, weights).select(
        F.coalesce("source", F.lit("")).alias("source_name"),
        F.col("source").isNotNull().alias("source_known"),
        "source_size",
        "target",
    )
    by_class = Window.partitionBy(*of_source).orderBy("size_class")
    by_lane = Window.partitionBy(*of_class).orderBy("lane")
    before = (Window.unboundedPreceding, -1)
    lanes = laid.groupBy(*place).agg(F.count("*").alias("rows"))
    classes = (
        lanes.groupBy(*of_class)
        .agg(F.sum("rows").alias("rows"))
        .select(*of_class, F.coalesce(F.sum("rows").over(by_class.rowsBetween(*before)), F.lit(0)).alias("class_base"))
    )
    bases = (
        lanes.select(*place, F.coalesce(F.sum("rows").over(by_lane.rowsBetween(*before)), F.lit(0)).alias("lane_base"))
        .join(classes, of_class)
        .join(targets, of_source)
        .select(*place, "source_size", "target", (F.col("class_base") + F.col("lane_base")).alias("base"))
    )
    within = Window.partitionBy(*place).orderBy("size", "doc_id")
    numbered = laid.withColumn("position", F.row_number().over(within))
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col("source_name")).cast("binary"))
    offset = F.conv(F.substring(digest, 1, 5), 16, 10).cast("double") / F.lit(float(OFFSET_STEPS))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    last = (F.col("base") + F.col("position")).cast("double")
    # The document's expected copies end at rate * last and begin at rate * (last - 1).
    crossed = F.floor(offset + rate * last) - F.floor(offset + rate * (last - 1))
    copies = F.least(crossed, F.ceil(rate)).cast("int")
    return numbered.join(bases, place).withColumn("copies", copies).drop(*named, "position", "base")


def mix_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    cap: int = CAP,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = 7,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as its copies say, same columns."""
    sized = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{source_column}`").alias("source"),
        n_words(F.col(f"`{text_column}`")).alias("size"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    taken = _sampled(sized, cap, weights, seed).where(F.col("copies") > 0)
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")
