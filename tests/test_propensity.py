import random

import pytest
from library_rows import SF_TINY
from pyspark.sql import functions as F

from tidemart import catalogue
from tidemart.operators import propensity


def brute_metrics(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    precision = 0.0
    for threshold in sorted(set(s for s, _ in rows), reverse=True):
        above = [y for s, y in rows if s >= threshold]
        hits = sum(1 for s, y in rows if s == threshold and y)
        precision += hits * sum(above) / len(above)
    return wins / (len(pos) * len(neg)), precision / len(pos)


@pytest.mark.parametrize("levels", [3, 50, 10_000])
def test_metrics_match_brute_force(spark, levels):
    draw = random.Random(levels)
    rows = [(draw.randint(0, levels) / levels, draw.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "propensity_score DOUBLE, did_purchase INT").repartition(4)
    row = propensity.ranking_metrics(df).first()
    auc, precision = brute_metrics(rows)
    assert row.users == 400
    assert row.positive_rate == pytest.approx(sum(y for _, y in rows) / 400)
    assert row.roc_auc == pytest.approx(auc) and row.avg_precision == pytest.approx(precision)


def test_rows_without_score_or_label_are_set_aside(spark):
    rows = [(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)]
    aside = [(None, 0), (float("nan"), 1), (0.5, None), (None, None)]
    schema = "propensity_score DOUBLE, did_purchase INT"
    row = propensity.ranking_metrics(spark.createDataFrame(rows + aside, schema)).first()
    auc, precision = brute_metrics(rows)
    assert (row.users, row.unranked) == (4, 4)
    assert row.roc_auc == pytest.approx(auc) and row.avg_precision == pytest.approx(precision)


def test_crowded_scores_are_spread_over_slices(spark):
    """All scores within a thousandth of each other still match brute force."""
    draw = random.Random(5)
    rows = [(draw.randint(0, 10_000) / 1e7, int(draw.random() < 0.1)) for _ in range(600)]
    df = spark.createDataFrame(rows, "propensity_score DOUBLE, did_purchase INT")
    row = propensity.ranking_metrics(df).first()
    auc, precision = brute_metrics(rows)
    assert row.roc_auc == pytest.approx(auc) and row.avg_precision == pytest.approx(precision)


def test_scores_are_computed_once(spark):
    counted = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(number):
        counted.add(1)
        return number / 100

    users = spark.range(100).select(score("id").alias("propensity_score"), (F.col("id") % 2).alias("did_purchase"))
    propensity.ranking_metrics(users).collect()
    assert counted.value == 100


def test_training_refuses_a_single_class(spark):
    rows = [(f"u{i}", i % 4, i % 5, 1, 1) for i in range(20)]
    schema = "user_id STRING, sessions_30d INT, events_30d INT, cart_adds_30d INT, did_purchase INT"
    with pytest.raises(ValueError, match="both classes"):
        propensity.fit_propensity(spark.createDataFrame(rows, schema))


def test_metrics_of_one_class_are_null(spark):
    df = spark.createDataFrame([(0.2, 1), (0.4, 1)], "propensity_score DOUBLE, did_purchase INT")
    row = propensity.ranking_metrics(df).first()
    assert (row.users, row.positive_rate, row.roc_auc, row.avg_precision) == (2, 1.0, None, None)


def test_bands_are_right_closed(spark):
    scores = [-0.02, 0.0, 0.33, 0.330001, 0.66, 0.660001, 1.0, 1.1, None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i INT, s DOUBLE")
    bands = [r.b for r in df.select("i", propensity.score_band("s").alias("b")).orderBy("i").collect()]
    assert bands == [None, "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", None, None]


def test_train_register_load_score(spark, tmp_path):
    labelled = propensity.with_split(catalogue._labelled(spark, SF_TINY))
    settings = propensity.TreeSettings(trees=3)
    model = propensity.fit_propensity(labelled, settings)
    root = str(tmp_path / "models")
    assert propensity.latest_version(spark, root) is None
    with pytest.raises(LookupError):
        propensity.load_model(spark, root)
    assert propensity.register_model(spark, model, root, settings, {"roc_auc": 0.5}) == 1
    assert propensity.register_model(spark, model, root, settings) == 2
    version, latest = propensity.load_model(spark, root)
    scores = propensity.propensity_table(propensity.predict(latest, labelled), version).collect()
    assert version == 2 and len(scores) == labelled.count()
    assert all(0 <= r.propensity_score <= 1 and r.model_version == "2" for r in scores)
    assert {r.score_band for r in scores} <= {"LOW", "MEDIUM", "HIGH"}


def test_merging_equal_users_does_not_change_the_trees(spark):
    """The same users listed once or three times give the same balanced model."""
    draw = random.Random(3)
    rows = [
        (f"u{i}", draw.randint(1, 6), draw.randint(1, 9), draw.randint(0, 4), draw.randint(0, 1))
        for i in range(80)
    ]
    schema = "user_id STRING, sessions_30d INT, events_30d INT, cart_adds_30d INT, did_purchase INT"
    once = spark.createDataFrame(rows, schema)
    thrice = once.unionAll(once).unionAll(once)
    settings = propensity.TreeSettings(trees=3)
    scores = []
    for users in (once, thrice):
        model = propensity.fit_propensity(users, settings)
        scored = propensity.predict(model, once).orderBy("user_id").collect()
        scores.append([r.propensity_score for r in scored])
    assert scores[0] == pytest.approx(scores[1])


def test_split_is_stable_and_near_its_share(spark):
    users = spark.range(4000).selectExpr("concat('u', id) AS user_id")
    sides = propensity.with_split(users)
    train = sides.filter("side = 'train'").count()
    assert train == propensity.with_split(users.repartition(9)).filter("side = 'train'").count()
    assert abs(train / 4000 - 0.75) < 0.03
