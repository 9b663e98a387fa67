"""MinHash near-duplicates against brute force over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from text_rows import DOCUMENTS, ODD_ROWS, components, words

from tidemart.llm import lsh_forest


def shingles(text, n=5):
    own = words(text)
    if not own:
        return frozenset()
    return frozenset(b" ".join(own[i : i + n]) for i in range(max(1, len(own) - n + 1)))


def brute_force(texts):
    """(n_shingles, component) of each key."""
    sets = {i: shingles(t) for i, t in texts.items()}

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return both > 0 and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both)

    return {i: (len(sets[i]), c) for i, c in components(sets, linked).items()}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def families(seed, groups=25, copies=12, changes=6):
    """Texts of many families around one shared passage, copies with changed words, repeated lines, short texts."""
    draw = np.random.default_rng(seed)
    passage = [f"p{int(x)}" for x in draw.integers(0, 10**6, 120)]
    texts = []
    for _ in range(groups):
        own = [f"w{int(x)}" for x in draw.integers(0, 10**6, 160)]
        for _ in range(copies):
            copy = passage + list(own)
            for at in draw.choice(len(copy), int(draw.integers(0, changes)), replace=False):
                copy[at] = f"z{int(draw.integers(0, 10**6))}"
            texts.append(" ".join(copy))
        texts.append(" ".join(passage + own + own[:16] * 20))
    for n in (1, 3, 4, 5, 6, 7, 12):
        line = " ".join(f"s{n}-{k}" for k in range(n))
        texts += [line, line.upper(), line + " more", line + "\n"]
    order = draw.permutation(len(texts))
    return {int(i): texts[o] for i, o in enumerate(order)}


def test_query_equals_brute_force(results, given):
    texts = {d["doc_id"]: d["text"] for d in given("documents")}
    rows = results("op12_lsh_forest")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_force(texts)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


@pytest.mark.parametrize("rows, tokens", [(4096, 1 << 21), (16, 1 << 21), (4096, 2000)])
def test_families_around_one_passage(spark, monkeypatch, rows, tokens):
    """Also where clusters are larger than a task takes, so the forest and chunks split them."""
    monkeypatch.setattr(lsh_forest, "REGION_ROWS", max(24, rows // 4))
    texts = families(3)
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], DOCUMENTS)
    mine, theirs = found(lsh_forest.near_duplicates(frame, max_rows=rows, max_shingles=tokens)), brute_force(texts)
    same = sum(mine[i] == theirs[i] for i in theirs)
    # Clusters that are not split are compared whole; here, regions of 7 rows may part a member or two.
    assert same == len(theirs) if rows == 4096 and tokens == 1 << 21 else same >= 0.98 * len(theirs)


def test_chunks_of_one_region_meet(spark, monkeypatch):
    """Classes alike in all minima of a tree, too many for a task: every pair is still compared."""
    draw = np.random.default_rng(9)
    own = [f"w{int(x)}" for x in draw.integers(0, 10**6, 3000)]
    texts = {}
    for i in range(80):
        copy = list(own)
        copy[int(draw.integers(0, len(own)))] = f"z{i}"
        texts[i] = " ".join(copy)
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], DOCUMENTS)
    monkeypatch.setattr(lsh_forest, "REGION_ROWS", 20)
    assert set(found(lsh_forest.near_duplicates(frame, max_rows=20)).values()) >= {v for v in brute_force(texts).values()}
    assert {c for _, c in found(lsh_forest.near_duplicates(frame, max_rows=20)).values()} == {0}


def test_odd_rows(odd, nothing):
    rows = sorted(lsh_forest.near_duplicates(odd).collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    assert [r.doc_id for r in rows] == sorted((r[0] for r in ODD_ROWS), key=lambda i: (i is not None, i))
    named = {r.doc_id: r.component_id for r in rows}
    # The NULL key's text differs in one of two shingles.
    assert named == {None: None, 1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9}
    assert [r.n_shingles for r in rows if r.doc_id in (3, 4, 5, 6, 8)] == [0, 0, 0, 1, 1]
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    assert lsh_forest.near_duplicates(nothing).count() == 0


def test_sets_of_long_words_and_texts():
    long = "x" * 3_000_000
    one, other = lsh_forest.shingle_sets([f"a {long} b c d e", f"a {long[:-1]}y b c d e"])
    assert len(one) == 2 and not set(one.tolist()) & set(other.tolist())
    again = lsh_forest.shingle_sets(["q " * 5, "", f"a {long} b c d e"])
    assert (again[2] == one).all() and [len(s) for s in again] == [1, 0, 2]


def test_forest_finds_pairs_at_the_similarity(spark):
    """Recall of the candidate search alone, at similarities from 0.85."""
    draw = np.random.default_rng(17)
    rows, pairs = [], []
    for i in range(400):
        base = draw.integers(0, 1 << 63, 200, dtype=np.uint64)
        other = base.copy()
        other[:16] = draw.integers(0, 1 << 63, 16, dtype=np.uint64)  # 184 of 216: 0.852
        for k, s in enumerate((base, other)):
            rows.append((bytes([k]) + i.to_bytes(15, "big"), 200, lsh_forest.minima([np.unique(s)])[0].tobytes()))
        pairs.append((rows[-2][0], rows[-1][0]))
    classes = spark.createDataFrame(rows, "node binary, n_shingles long, minima binary")
    links = lsh_forest.loose_links(*lsh_forest.regions(classes, 8192), classes)
    met = {frozenset((bytes(r.a), bytes(r.b))) for r in links.collect()}
    assert sum(frozenset(p) in met for p in pairs) >= 399
