"""Review corpus: per-category slices to one typed review table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.contracts import REVIEW_FIELDS, REVIEW_SOURCE
from tidemart.functions.text import clip, is_blank, squash
from tidemart.operators.keyed import lowest_n
from tidemart.sources.positions import read_numbered


def load_reviews(
    spark: SparkSession,
    paths_by_category: Mapping[str, str],
    limit: int | None = None,
    fmt: str = "parquet",
    title_chars: int | None = None,
    text_chars: int | None = None,
    numbered: bool = True,
) -> DataFrame:
    """Union of the category slices: all records with their whole texts.

    On request each slice is cut to its first ``limit`` records by ``seq``, the
    record's position in its slice, and titles and texts to a number of
    characters. Blank reviews count toward the limit and are dropped afterwards.
    Files that are not ``numbered`` have no ``seq`` column; the position then is that of the
    record in the slice's files, in order of their names.
    """
    slices = []
    for category, path in paths_by_category.items():
        if not numbered:
            records = read_numbered(spark, path, REVIEW_FIELDS, fmt, "seq", limit)
        else:
            records = spark.read.schema(REVIEW_SOURCE).format(fmt).load(path)
            if limit is not None:
                records = lowest_n(records, "seq", limit)
        slices.append(records.withColumn("product_category", F.lit(category)))
    return type_reviews(reduce(DataFrame.unionByName, slices), title_chars, text_chars)


def type_reviews(
    records: DataFrame, title_chars: int | None = None, text_chars: int | None = None
) -> DataFrame:
    """Raw review records (with their category) to the review table.

    Stars are the whole part of the rating. The bounds are put on the rating
    itself, a plain comparison the file scan can skip row groups by.
    """
    rating = F.col("rating")
    millis = F.coalesce("timestamp", F.lit(0).cast("bigint"))
    return records.filter((rating >= 1) & (rating < 6) & ~is_blank("text")).select(
        F.concat_ws("-", "product_category", F.col("seq").cast("string")).alias("review_id"),
        "product_category",
        rating.cast("int").alias("star_rating"),
        clip(F.coalesce("title", F.lit("")), title_chars).alias("review_title"),
        clip(squash("text"), text_chars).alias("review_text"),
        F.to_date(F.timestamp_millis(millis)).alias("review_date"),
    )
