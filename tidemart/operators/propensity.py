"""Purchase propensity: features, split, boosted trees, metrics, scores, bands."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.contracts import BAND_EDGES, BAND_FLOOR
from tidemart.operators.gold import user_features, user_purchases
from tidemart.session import ensure_checkpoint_dir, scratch_dir
from tidemart.sources.tables import read_table, read_table_or_empty

FEATURES = ["sessions_30d", "events_30d", "cart_adds_30d"]
LABEL = "did_purchase"
SEED = 42

# MLlib sees all rows up to this many when it chooses where features may be cut, and tries at most BINS - 1 cuts of each.
EXACT_ROWS = 10_000
BINS = 32

# Distinct scores are ranked in this many slices.
SCORE_SLICES = 512


@dataclass(frozen=True)
class TreeSettings:
    """Boosting parameters; depth 5 allows about 31 leaves per tree."""

    trees: int = 300
    learning_rate: float = 0.05
    depth: int = 5
    seed: int = SEED


def labelled_features(events: DataFrame, orders: DataFrame, label_day: dt.date) -> DataFrame:
    """Features from before ``label_day``; the label is a purchase on or after it.

    Keeps the label out of the span the features are counted over.
    """
    before = F.col("event_date") < F.lit(label_day)
    past = user_features(events.filter(before), orders.filter(before)).drop(LABEL)
    buyers = user_purchases(orders.filter(~before)).withColumnRenamed("purchases_prior", "bought")
    bought = F.coalesce("bought", F.lit(0)) > 0
    return (
        past.join(buyers, "user_id", "left").withColumn(LABEL, bought.cast("int")).drop("bought")
    )


def split_side(user: str | Column, train_percent: int = 75, seed: int = SEED) -> Column:
    """'train' or 'validation' by a hash of the user: repeatable and shuffle-free.

    Every label gets the same shares in expectation, whatever its size.
    """
    user = F.col(user) if isinstance(user, str) else user
    digest = F.md5(F.concat(user, F.lit(str(seed))).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return F.when(bucket < train_percent, "train").otherwise("validation")


def with_split(features: DataFrame) -> DataFrame:
    return features.withColumn("side", split_side("user_id"))


def fit_propensity(training: DataFrame, settings: TreeSettings = TreeSettings()) -> PipelineModel:
    """Boosted trees with balanced classes.

    Users with the same counts and label are the same training example, so they
    are merged into one weighted row first: the loss is unchanged, while the
    data every boosting round passes over shrinks from users to distinct rows.
    They are written out, so that no round goes back to the events. More than ``EXACT_ROWS``
    of them are merged once more by the bins of their features, at most ``BINS`` each: trees tell no more
    values apart. So the rounds, which are many small jobs, pass over a bounded number of rows, in one task.
    """
    spark = training.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_dir(spark, "training")
    training.groupBy(*FEATURES, LABEL).agg(F.count("*").alias("users")).write.parquet(path)
    merged = spark.read.parquet(path)
    cuts = _feature_cuts(merged) if merged.count() > EXACT_ROWS else None
    if cuts is not None:
        # A bin is known by a value that lies in it, since the model cuts the features itself.
        kept = [F.min(name).alias(name) for name in FEATURES]
        merged = cuts.transform(merged).groupBy(*cuts.getOutputCols(), LABEL).agg(F.sum("users").alias("users"), *kept)
        path = scratch_dir(spark, "binned")
        merged.select(*FEATURES, LABEL, "users").write.parquet(path)
        merged = spark.read.parquet(path)
    merged = merged.coalesce(1)
    by_label = merged.groupBy(LABEL).agg(F.sum("users").alias("users"))
    sizes = {row[LABEL]: row["users"] for row in by_label.collect()}
    if len(sizes) < 2:
        raise ValueError(f"training needs users of both classes, found {sizes}")
    total = sum(sizes.values())
    balance = F.coalesce(
        *[F.when(F.col(LABEL) == label, total / (2.0 * n)) for label, n in sizes.items()]
    )
    weighted = merged.withColumn("weight", F.col("users") * balance)
    trees = GBTClassifier(
        labelCol=LABEL,
        weightCol="weight",
        maxIter=settings.trees,
        stepSize=settings.learning_rate,
        maxDepth=settings.depth,
        seed=settings.seed,
    )
    if cuts is None:
        stages = [VectorAssembler(inputCols=FEATURES, outputCol="features")]
    else:
        # Bins are marked as categories; computed from, they are numbers in order.
        ranks = ", ".join(f"{name}_bin + 0 AS {name}_rank" for name in FEATURES)
        numbers = SQLTransformer(statement=f"SELECT *, {ranks} FROM __THIS__")
        stages = [cuts, numbers, VectorAssembler(inputCols=[f"{name}_rank" for name in FEATURES], outputCol="features")]
    return Pipeline(stages=[*stages, trees]).fit(weighted)


def _feature_cuts(merged: DataFrame) -> Bucketizer:
    """Every feature into at most ``BINS`` bins of about equally many users; values stay apart where they are few."""
    shares = [i / BINS for i in range(1, BINS)]
    quantiles = [F.percentile(name, shares, F.col("users")).alias(name) for name in FEATURES]
    values = [F.count_distinct(name).alias(f"{name}_values") for name in FEATURES]
    found = merged.agg(*quantiles, *values).first()
    splits = []
    for name in FEATURES:
        inner = found[name]
        if found[f"{name}_values"] <= BINS:
            inner = [r[0] for r in merged.select(name).distinct().collect()]
        splits.append([-math.inf, *sorted({float(value) for value in inner}), math.inf])
    return Bucketizer(splitsArray=splits, inputCols=FEATURES, outputCols=[f"{name}_bin" for name in FEATURES])


def predict(model: PipelineModel, users: DataFrame) -> DataFrame:
    """``users`` with ``propensity_score``, the probability of a purchase."""
    scored = model.transform(users)
    score = vector_to_array("probability")[1]
    return scored.select(*users.columns, score.alias("propensity_score"))


def score_band(score: str | Column) -> Column:
    """Right-closed bands LOW, MEDIUM, HIGH; NULL outside all of them."""
    score = F.col(score) if isinstance(score, str) else score
    upper = [F.when(score <= edge, F.lit(band)) for band, edge in BAND_EDGES.items()]
    return F.when(score > BAND_FLOOR, F.coalesce(*upper))


def propensity_table(scored: DataFrame, version: int | str) -> DataFrame:
    """The published score table."""
    return scored.select(
        "user_id",
        *FEATURES,
        "purchases_prior",
        "propensity_score",
        score_band("propensity_score").alias("score_band"),
        F.lit(str(version)).alias("model_version"),
        F.current_timestamp().alias("scored_at"),
    )


def ranking_metrics(
    scored: DataFrame, score: str = "propensity_score", label: str = LABEL
) -> DataFrame:
    """One row: users, positive rate, ROC-AUC and average precision, all exact.

    Rows without a score (NULL or NaN) or without a label are set aside and
    counted as ``unranked``; the metrics are over the others.

    Both curves need running totals over descending scores. Rows are first
    merged by distinct score and written out, so scores are computed once.
    Running totals are then taken inside slices cut at quantiles of the distinct
    scores, on top of the totals of the slices above, so no window covers the
    whole table, wherever the scores crowd. A metric without both classes is NULL.
    """
    spark = scored.sparkSession
    s, hit = F.col(score), F.col(label) == 1
    usable = s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull()
    path = scratch_dir(spark, "scores")
    (
        scored.select(F.when(usable, s).alias("s"), usable.alias("usable"), hit.alias("hit"))
        .groupBy("s", "usable")
        .agg(
            F.count_if(F.col("usable") & F.col("hit")).alias("pos"),
            F.count_if(F.col("usable") & ~F.col("hit")).alias("neg"),
            F.count_if(~F.col("usable")).alias("unranked"),
        )
        .write.parquet(path)
    )
    counted = read_table(spark, path)
    merged = counted.filter("usable").select("s", "pos", "neg")
    shares = [i / SCORE_SLICES for i in range(1, SCORE_SLICES)]
    inner = sorted(set(merged.approxQuantile("s", shares, 0.5 / SCORE_SLICES) or [0.0]))
    cuts = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol="s", outputCol="slice")
    merged = cuts.transform(merged)
    slices = merged.groupBy("slice").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # At most SCORE_SLICES rows, which is what makes this unpartitioned window
    # and the broadcast below safe.
    above = Window.orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        "slice",
        F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("pos_above"),
        F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("neg_above"),
    )
    inside = Window.partitionBy("slice").orderBy(F.desc("s"))
    ranked = merged.join(F.broadcast(offsets), "slice").select(
        "pos",
        "neg",
        (F.sum("pos").over(inside) + F.col("pos_above")).alias("tp"),
        (F.sum("neg").over(inside) + F.col("neg_above")).alias("fp"),
    )
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    # Negatives ranked above a positive lose its pair; equal scores count half.
    lost = F.col("pos") * (F.col("fp") - F.col("neg")) + F.col("pos") * F.col("neg") / 2
    totals = ranked.agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.sum(F.col("pos") * precision).alias("precision_sum"),
        F.sum(lost).alias("lost_pairs"),
    )
    aside = counted.agg(F.coalesce(F.sum("unranked"), F.lit(0)).alias("unranked"))
    pairs = F.nullif(F.col("positives") * F.col("negatives"), F.lit(0))
    users = F.col("positives") + F.col("negatives")
    return totals.select(
        F.coalesce(users, F.lit(0)).alias("users"),
        (F.col("positives") / F.nullif(users, F.lit(0))).alias("positive_rate"),
        (1 - F.col("lost_pairs") / pairs).alias("roc_auc"),
        F.when(pairs.isNotNull(), F.col("precision_sum") / F.col("positives")).alias(
            "avg_precision"
        ),
        aside.scalar().alias("unranked"),
    )


# --- model registry -------------------------------------------------------------

REGISTRY = """
    version INT, trained_at TIMESTAMP,
    params MAP<STRING,STRING>, metrics MAP<STRING,DOUBLE>
"""


def _registry(spark: SparkSession, root: str) -> DataFrame:
    return read_table_or_empty(spark, f"{root}/registry", REGISTRY)


def register_model(
    spark: SparkSession,
    model: PipelineModel,
    root: str,
    settings: TreeSettings = TreeSettings(),
    metrics: Mapping[str, float | None] | None = None,
    training: DataFrame | None = None,
) -> int:
    """Save the model as the next version and record its parameters and metrics.

    With the ``training`` rows given, three of them are kept as an input example.

    The registry row is written last: a version is only found once it is whole.
    """
    version = (latest_version(spark, root) or 0) + 1
    model.write().overwrite().save(f"{root}/version={version}")
    if training is not None:
        example = training.select(*FEATURES).limit(3)
        example.write.mode("overwrite").json(f"{root}/examples/version={version}")
    params = {name: str(value) for name, value in asdict(settings).items()}
    row = (version, dt.datetime.now(dt.timezone.utc), params, dict(metrics or {}))
    entry = spark.createDataFrame([row], REGISTRY)
    entry.coalesce(1).write.mode("append").parquet(f"{root}/registry")
    return version


def latest_version(spark: SparkSession, root: str) -> int | None:
    return _registry(spark, root).agg(F.max("version")).first()[0]


def load_model(
    spark: SparkSession, root: str, version: int | None = None
) -> tuple[int, PipelineModel]:
    """A registered model and its version; the latest one unless told otherwise."""
    version = latest_version(spark, root) if version is None else version
    if version is None:
        raise LookupError(f"no model registered under {root}")
    return version, PipelineModel.load(f"{root}/version={version}")
