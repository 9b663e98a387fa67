"""Language identification: families first, then one-versus-one SVMs within the family.

Features are relative frequencies of hashed byte bigrams and trigrams of the
lower-cased text, everything that is no letter of ASCII read as a space. Linear
support vector machines are fitted for every pair of families and for every pair
of languages of one family. A document first gets the family that wins the
family votes; only the machines of that family then decide the language.

Fitting uses at most about ``per_language`` rows of each language, drawn by a hash of the key
(a documented bound: the sample and its feature rows are all that reaches the
driver). Prediction reads whole texts.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, as
is every text if nothing could be learned; with a single language learned, that
language with score 1; ties between languages go to the first in code point
order. Rows are independent, so repeated rows get equal results; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import fold, map_batches, narrow, text_chunks

UNKNOWN = "und"
PER_LANGUAGE = 400
DIMENSIONS = 1 << 13
CHUNK_CHARS = 1 << 20
# Language families by ISO 639-1 code; a language not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
}

_SPACED = bytes(c if c >= 128 or chr(c).isalpha() or c == 0 else 32 for c in range(256))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashed bigrams and trigrams of all texts in a row, and where each text begins and ends."""
    encoded = [f" {t.lower()} ".encode().translate(_SPACED) for t in texts]
    sizes = np.array([len(e) for e in encoded])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(encoded), dtype=np.uint8).astype(np.uint32)
    pairs = data[:-1] * np.uint32(256) + data[1:]
    triples = pairs[:-1] * np.uint32(256) + data[2:]
    mixed = [pairs * np.uint32(0x9E3779B1), (triples ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B)]
    shift = np.uint32(32 - (DIMENSIONS.bit_length() - 1))
    return [m >> shift for m in mixed], ends - sizes, ends


def histograms(texts: list[str]) -> list[np.ndarray]:
    """Relative gram frequencies of each text."""
    grams, begins, ends = _grams(texts)
    rows = []
    for begin, end in zip(begins, ends):
        counts = sum(np.bincount(g[begin : max(begin, end - n)], minlength=DIMENSIONS) for n, g in enumerate(grams, 1))
        rows.append(counts / max(1, counts.sum()))
    return rows


@dataclass
class Machine:
    """Positive margins speak for ``one``, negative for ``other``."""

    one: str
    other: str
    weights: np.ndarray
    bias: float


def fit_machine(one: str, other: str, rows_one: np.ndarray, rows_other: np.ndarray, cost: float = 10.0, epochs: int = 30) -> Machine:
    """A linear SVM by dual coordinate descent; classes weigh the same in total."""
    x = np.vstack([rows_one, rows_other])
    scale = 1.0 / np.sqrt(x.mean(axis=0) + 1e-5)
    x = (x * scale).astype(np.float32)
    norm = float(np.sqrt((x * x).sum(axis=1)).mean()) or 1.0
    x = np.hstack([x / norm, np.ones((len(x), 1), dtype=np.float32)])
    y = np.concatenate([np.ones(len(rows_one)), -np.ones(len(rows_other))])
    bound = np.where(y > 0, len(y) / (2 * len(rows_one)), len(y) / (2 * len(rows_other))) * cost
    kernel = (x @ x.T).astype(np.float64)
    alpha, margin = np.zeros(len(y)), np.zeros(len(y))
    order = np.random.default_rng(1)
    for _ in range(epochs):
        for i in order.permutation(len(y)):
            new = min(max(alpha[i] + (1 - y[i] * margin[i]) / kernel[i, i], 0.0), bound[i])
            if new != alpha[i]:
                margin += (new - alpha[i]) * y[i] * kernel[i]
                alpha[i] = new
    w = (alpha * y) @ x
    return Machine(one, other, (w[:-1] * scale / norm).astype(np.float64), float(w[-1]))


@dataclass
class LanguageModel:
    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if not self.families or not texts:
            return [(UNKNOWN, 0.0)] * len(texts)
        grams, begins, ends = _grams(texts)
        counts = sum(np.maximum(0, ends - n - begins) for n in (1, 2))
        machines = [*self.between, *(m for ms in self.within.values() for m in ms)]
        margins = {}
        for machine in machines:
            total = np.zeros(len(texts))
            for n, g in enumerate(grams, 1):
                running = np.concatenate([[0.0], np.cumsum(machine.weights[g])])
                total += running[np.maximum(begins, ends - n)] - running[begins]
            margins[machine.one, machine.other] = total / np.maximum(1, counts) + machine.bias
        out = []
        for row in range(len(texts)):
            family, sure = _vote(list(self.families), self.between, margins, row)
            language, surer = _vote(self.families[family], self.within[family], margins, row)
            out.append((language, sure * surer))
        return out


def _vote(names: list[str], machines: list[Machine], margins: dict, row: int) -> tuple[str, float]:
    """The name that wins most duels, margins deciding ties, and its least sure duel."""
    wins, total, least = defaultdict(int), defaultdict(float), defaultdict(lambda: 1.0)
    for machine in machines:
        margin = float(margins[machine.one, machine.other][row])
        wins[machine.one if margin >= 0 else machine.other] += 1
        for name, own in ((machine.one, margin), (machine.other, -margin)):
            total[name] += own
            least[name] = min(least[name], float(1 / (1 + np.exp(-np.clip(3 * own, -50, 50)))))
    best = min(names, key=lambda name: (-wins[name], -total[name], name))
    return best, least[best]


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members), f"={language}")


def build_model(rows: dict[str, np.ndarray]) -> LanguageModel:
    """A model from feature rows by language."""
    families: dict[str, list[str]] = defaultdict(list)
    for language in sorted(rows):
        families[family_of(language)].append(language)
    stacked = {f: np.vstack([rows[name] for name in members]) for f, members in families.items()}
    between = [fit_machine(a, b, stacked[a], stacked[b]) for a, b in combinations(sorted(families), 2)]
    within = {
        f: [fit_machine(a, b, rows[a], rows[b]) for a, b in combinations(members, 2)] for f, members in families.items()
    }
    return LanguageModel(dict(sorted(families.items())), between, within)


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fit on rows of (doc_id, text, lang), about ``per_language`` of each language."""
    usable = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return LanguageModel({}, [], {})
    steps = 1 << 30
    shares = F.create_map(
        *[F.lit(v) for k, n in counts.items() for v in (k, min(steps, per_language * steps // n))]
    )
    draw = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(steps))
    sample = usable.where(draw < shares[F.col("lang")])

    def make():
        def step(batch: pa.RecordBatch):
            languages = batch.column("lang").to_pylist()
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                rows = histograms(texts)
                held = [np.flatnonzero(r) for r in rows]
                yield {
                    "lang": languages[first : first + len(texts)],
                    "at": [h.astype(np.int32).tobytes() for h in held],
                    "share": [r[h].astype(np.float32).tobytes() for r, h in zip(rows, held)],
                }

        return step

    rows: dict[str, list[np.ndarray]] = defaultdict(list)
    for row in map_batches(sample, make, "lang string, at binary, share binary").collect():
        dense = np.zeros(DIMENSIONS, dtype=np.float32)
        dense[np.frombuffer(row["at"], dtype=np.int32)] = np.frombuffer(row["share"], dtype=np.float32)
        rows[row["lang"]].append(dense)
    return build_model({k: np.vstack(v) for k, v in rows.items()})


def training_rows(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, text, lang) of the documents outside the held fold; a NULL key is never learned from."""
    rows = docs.select("doc_id", "text", "lang")
    return rows.where(fold(F.col("doc_id"), folds) != held)


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every document, from the whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = narrow(docs).withColumn("lettered", has_letter(F.col("text")))

    def make():
        learned = shared.value

        def step(batch: pa.RecordBatch):
            ids, lettered = batch.column("doc_id"), batch.column("lettered").to_pylist()
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                found = learned.predict(texts)
                kept = [f if lettered[first + i] else (UNKNOWN, 0.0) for i, f in enumerate(found)]
                yield {
                    "doc_id": ids.slice(first, len(texts)),
                    "lang_pred": [k[0] for k in kept],
                    "score": [min(1.0, max(0.0, k[1])) for k in kept],
                }

        return step

    key = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, make, f"doc_id {key}, lang_pred string, score double")


def keep_recognised(docs: DataFrame, model: LanguageModel, least_score: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is recognised with at least ``least_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    marked = docs.withColumn("__lettered", has_letter(F.col("text")))

    def run(batches):
        learned = shared.value
        for batch in batches:
            lettered = batch.column("__lettered").to_pylist()
            kept = []
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                kept += [lettered[first + i] and f[1] >= least_score for i, f in enumerate(learned.predict(texts))]
            yield batch.drop_columns(["__lettered"]).filter(pa.array(kept, type=pa.bool_()))

    return marked.mapInArrow(run, docs.schema)
