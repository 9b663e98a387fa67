"""Toxicity by maximum-scoring segments of token log-odds.

Learning. A token's weight is its log-odds of standing in a toxic rather than in
a clean labelled document, with an informative Dirichlet prior: each class is
given the corpus' token proportions as pseudo-counts. Tokens whose weight is at
least ``LEAST_Z`` standard errors above zero (or about as many as the surest token's) keep it; all other tokens cost
``DRIFT``. At most about ``PER_CLASS`` labelled rows of each class are used,
drawn by a hash of the key; the bound is documented and only concerns fitting. It bounds the
lexicon, too, which is broadcast.

Scoring. One linear scan finds every maximal-scoring segment of the whole text
(all disjoint segments that cannot be improved by growing or cutting). Under
chance, a text of n tokens has ``K n exp(-lambda S)`` segments of score S or
more, lambda solving ``E[exp(lambda * weight)] = 1`` over clean tokens, K being the likeliest
for the best segments of the clean labelled sample. Segments
expected less than ``SIGNIFICANT`` times are toxic passages. A document's
evidence is the sum over these of ``lambda S - ln(K n)``; a logistic curve,
fitted on the labelled sample, turns the evidence into a probability.

Defined results: NULL and empty texts have no segment and get the probability of
no evidence; without rows of both classes every score is 0; repeated rows
get equal scores; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import fold, map_batches, narrow, text_chunks

PER_CLASS = 20_000
LEAST_Z = 2.5
DRIFT = -0.25
SIGNIFICANT = 0.05
THRESHOLD = 0.3
CHUNK_CHARS = 1 << 20
TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def maximal_segments(places: list[int], weights: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments as (first token, end token, score), in text order.

    ``places`` are the positions of the positive tokens, in order; every other
    token scores ``drift``. One pass: each positive token opens a candidate
    that is merged with earlier candidates while the stretch in between loses less than
    either side gains; each merge removes a candidate, so the scan is linear.
    """
    # (first, end, total score before, total score after)
    kept: list[tuple[int, int, float, float]] = []
    gained = 0.0
    for seen, (place, weight) in enumerate(zip(places, weights)):
        left = gained + drift * (place - seen)
        gained += weight
        current = (place, place + 1, left, left + weight)
        while kept:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= current[2]:
                j -= 1
            if j < 0 or kept[j][3] >= current[3]:
                break
            current = (kept[j][0], current[1], kept[j][2], current[3])
            del kept[j:]
        kept.append(current)
    return [(a, b, right - left) for a, b, left, right in kept]


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    rate: float  # lambda of the extreme-value law
    scale: float  # its K
    slope: float
    intercept: float
    drift: float = DRIFT

    def segments(self, words: list[str]) -> list[tuple[int, int, float]]:
        known = self.lexicon
        places = [i for i, w in enumerate(words) if w in known]
        return maximal_segments(places, [known[words[i]] for i in places], self.drift) if places else []

    def best(self, words: list[str]) -> float:
        return max([s[2] for s in self.segments(words)], default=0.0)

    def passages(self, words: list[str]) -> list[tuple[int, int, float]]:
        """Significant segments of a text as (first token, end token, surplus over chance)."""
        segments = self.segments(words)
        chance = math.log(self.scale * len(words)) if segments else 0.0
        found = []
        for first, end, score in segments:
            surplus = self.rate * score - chance
            if surplus > -math.log(SIGNIFICANT):
                found.append((first, end, surplus))
        return found

    def evidence(self, text: str) -> float:
        return sum(p[2] for p in self.passages(tokens(text)))

    def probability(self, evidence: float) -> float:
        z = self.slope * min(evidence, 100.0) + self.intercept
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


NOTHING = ToxicityModel({}, 1.0, 1.0, 0.0, -math.inf)


def extreme_value_rate(weights: np.ndarray, chances: np.ndarray, drift: float) -> float:
    """lambda > 0 with sum of chance * exp(lambda * weight) = 1, drift taking the rest, by bisection."""
    rest = 1.0 - chances.sum()

    def surplus(rate: float) -> float:
        return float((chances * np.exp(np.minimum(rate * weights, 700.0))).sum() + rest * math.exp(rate * drift) - 1.0)

    low, high = 1e-9, 1e-6
    while surplus(high) < 0 and high < 1e4:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if surplus(middle) < 0 else (low, middle)
    return low


def extreme_value_scale(best: np.ndarray, sizes: np.ndarray, rate: float) -> float:
    """The K that makes the best segment scores of texts likeliest, 1 without any.

    A best score of at most S has the chance ``exp(-K n exp(-rate S))``; texts without a segment (best 0)
    are known to stay below any score.
    """
    seen = best > 0
    weight = (sizes[seen] * np.exp(-rate * best[seen])).sum() + sizes[~seen].sum()
    return float(seen.sum() / weight) if seen.any() and weight > 0 else 1.0


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept of a weighted logistic fit with a light ridge, by Newton steps."""
    slope, intercept = 0.0, 0.0
    x = np.minimum(x, 100.0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(slope * x + intercept, -30, 30)))
        g = np.array([(weight * (y - p) * x).sum() - 1e-2 * slope, (weight * (y - p)).sum() - 1e-2 * intercept])
        v = weight * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1e-2, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-2]])
        move = np.linalg.solve(h, g)
        move *= min(1.0, 2.0 / max(1e-12, np.abs(move).max()))
        slope, intercept = slope + move[0], intercept + move[1]
        if np.abs(move).max() < 1e-9:
            break
    return float(slope), float(intercept)


def training_labels(labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, toxic) with a label of 0 or 1, outside the held fold; one row per document."""
    return (
        labels.where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), folds) != held))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    """Fit on the documents that ``labels`` (doc_id, toxic) names."""
    sizes = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    if set(sizes) != {0, 1}:
        return NOTHING
    steps = 1 << 30
    share = {k: min(1.0, per_class / n) for k, n in sizes.items()}
    draw = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(steps))
    chosen = labels.where(draw < F.when(F.col("toxic") == 1, int(share[1] * steps)).otherwise(int(share[0] * steps)))
    # At most about 2 * per_class pairs of numbers, so no text is shuffled to meet them.
    sample = narrow(docs).join(F.broadcast(chosen), "doc_id").select("toxic", "text")

    def count_presence():
        def step(batch: pa.RecordBatch):
            counts: dict[str, list[int]] = {}
            totals = [0, 0]
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                words = tokens(text or "")
                totals[toxic] += len(words)
                for word in set(words):
                    counts.setdefault(word, [0, 0])[toxic] += 1
            yield {
                "token": [*counts, ""],
                "clean": [*(c[0] for c in counts.values()), totals[0]],
                "toxic": [*(c[1] for c in counts.values()), totals[1]],
            }

        return step

    counted = (
        map_batches(sample, count_presence, "token string, clean long, toxic long")
        .groupBy("token")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    counted = counted.persist()
    try:
        all_of = counted.where(F.col("token") != "").agg(F.sum("clean"), F.sum("toxic")).first()
        if not all_of[0] or not all_of[1]:
            return NOTHING
        n_clean, n_toxic = float(all_of[0]), float(all_of[1])
        # Each class gets the corpus' proportions, as strong as the toxic class itself.
        prior = (F.col("clean") + F.col("toxic")) * F.lit(n_toxic / (n_clean + n_toxic))
        y1, y0 = F.col("toxic") + prior, F.col("clean") + prior
        weight = F.log(y1 / (F.lit(2 * n_toxic) - y1)) - F.log(y0 / (F.lit(n_clean + n_toxic) - y0))
        error = F.sqrt(1 / y1 + 1 / y0)
        sure = (
            counted.where((F.col("token") != "") & (F.col("toxic") > 0))
            .select("token", "clean", weight.alias("weight"), (weight / error).alias("z"))
            .where(F.col("z") > 1)
        )
        # With so few labels that no token is sure enough, those about as sure as the surest count.
        surest = sure.agg(F.max("z")).first()[0] or 0.0
        kept = sure.where(F.col("z") >= min(LEAST_Z, surest - 0.5)).orderBy("token").collect()
        clean_tokens = counted.where(F.col("token") == "").first()["clean"]
    finally:
        counted.unpersist()
    if not kept:
        return NOTHING
    weights = np.array([r["weight"] for r in kept])
    # Chance of each weight in clean text; unseen tokens share half an occurrence.
    seen = np.array([r["clean"] for r in kept], dtype=float)
    chances = (seen + 0.5 / len(kept)) / (clean_tokens + 1.0)
    model = ToxicityModel(
        {r["token"]: r["weight"] for r in kept}, extreme_value_rate(weights, chances, DRIFT), 1.0, 0.0, 0.0
    )
    x, sizes, y = _weighed(sample, model, lambda learned, words: learned.best(words))
    model.scale = extreme_value_scale(x[y == 0], sizes[y == 0], model.rate)
    x, _, y = _weighed(sample, model, lambda learned, words: sum(p[2] for p in learned.passages(words)))
    model.slope, model.intercept = fit_logistic(x, y, np.where(y == 1, 1 / share[1], 1 / share[0]))
    return model


def _weighed(
    sample: DataFrame, model: ToxicityModel, weigh: Callable[[ToxicityModel, list[str]], float]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``weigh`` makes of each text of the labelled sample, its number of tokens and its label."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def make():
        learned = shared.value

        def step(batch: pa.RecordBatch):
            words = [tokens(t or "") for t in batch.column("text").to_pylist()]
            yield {
                "toxic": batch.column("toxic"),
                "tokens": [len(w) for w in words],
                "weight": [weigh(learned, w) for w in words],
            }

        return step

    rows = map_batches(sample, make, "toxic int, tokens long, weight double").collect()
    return (*(np.array([r[c] for r in rows], dtype=float) for c in ("weight", "tokens")), np.array([r["toxic"] for r in rows]))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, passages, tokens_toxic) per document; passages are (first token, end token, surplus)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = narrow(docs)

    def make():
        learned = shared.value

        def step(batch: pa.RecordBatch):
            ids = batch.column("doc_id")
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                found = [learned.passages(tokens(t)) for t in texts]
                yield {
                    "doc_id": ids.slice(first, len(texts)),
                    "score": [learned.probability(sum(p[2] for p in f)) for f in found],
                    "passages": [[{"first": a, "end": b, "surplus": s} for a, b, s in f] for f in found],
                }

        return step

    key = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(
        rows, make, f"doc_id {key}, score double, passages array<struct<first:int,end:int,surplus:double>>"
    )


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        learned = shared.value
        for batch in batches:
            kept = [
                learned.probability(learned.evidence(text)) < threshold
                for _, texts in text_chunks(batch, CHUNK_CHARS)
                for text in texts
            ]
            yield batch.filter(pa.array(kept, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
