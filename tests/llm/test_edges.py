"""Odd input for every operator and stage: nulls, empty and long texts, ties, repeats, clashing columns, empty tables."""

import hashlib
import struct
from collections import Counter

import numpy as np
import pytest
from text_rows import DOCUMENTS, ODD_ROWS, SF, simhash_components
from pyspark.sql import functions as F

from tidemart.llm import (
    bpe,
    language,
    lm,
    mixing,
    parsing,
    queries,
    simhash,
    token_counts,
    token_files,
    topk,
    toxicity,
)

IDS = sorted((r[0] for r in ODD_ROWS), key=lambda i: (i is not None, i))
LABELS = "doc_id long, toxic int"


def collected(frame):
    return sorted(frame.collect(), key=lambda r: (r.doc_id is not None, r.doc_id, str(r)))


def ids(frame):
    return [r.doc_id for r in collected(frame)]


def test_language(spark, odd, nothing):
    model = language.learn(language.training_rows(odd))
    rows = collected(language.predict_languages(odd, model))
    assert [r.doc_id for r in rows] == IDS
    unknown = {r.doc_id for r in rows if r.lang_pred == language.UNKNOWN}
    assert {3, 4, 5, 6} <= unknown and not {7, 8} & unknown
    assert language.predict_languages(nothing, model).count() == 0
    empty = language.learn(language.training_rows(nothing))
    assert {r.lang_pred for r in language.predict_languages(odd, empty).collect()} == {language.UNKNOWN}
    kept = language.keep_recognised(odd, model, 0.0)
    assert kept.columns == odd.columns and not {3, 4, 5, 6} & set(ids(kept))


def test_mixing(odd, nothing):
    rows = collected(mixing.mix_copies(odd))
    assert [r.doc_id for r in rows] == IDS
    sizes = {r.doc_id: r.size for r in rows}
    assert (sizes[3], sizes[4], sizes[5], sizes[7], sizes[8]) == (0, 0, 0, 60_000, 1)
    total = sum({r.source: r.target for r in rows}.values())
    assert total == pytest.approx(sum(r.size for r in rows))
    assert all(r.target <= 3 * r.source_size + 1e-6 and 0 <= r.copies <= 3 for r in rows)
    mixed = mixing.mix_documents(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r.copies for r in rows)
    expected = Counter()
    for r in rows:
        expected[r.doc_id] += r.copies
    assert Counter(ids(mixed)) == +expected
    assert mixing.mix_copies(nothing).count() == mixing.mix_documents(nothing).count() == 0


def test_targets_by_brute_force(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, "d": 0, None: 400, "é": 7}
    frame = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    names = sorted((k for k in sizes if k is not None)) + [None]
    weight = {k: (1, 2, 3)[i % 3] for i, k in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[k] for k in capped)
        share = rest / sum(weight[k] for k in names if k not in capped)
        over = {k for k in names if k not in capped and share * weight[k] > 3 * sizes[k]}
        if not over:
            break
        capped |= over
    for k in names:
        assert found[k] == pytest.approx(3 * sizes[k] if k in capped else share * weight[k])


def test_simhash(odd, nothing):
    rows = collected(simhash.near_duplicates(odd))
    assert [r.doc_id for r in rows] == IDS
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].fp == by_id[4].fp == by_id[5].fp == 0
    assert by_id[1].component_id == by_id[2].component_id == 1
    assert by_id[3].component_id == by_id[4].component_id == by_id[5].component_id == 3
    assert simhash.near_duplicates(nothing).count() == 0


def test_crowded_keys_are_linked_through_neighbourhoods(spark, monkeypatch):
    """More fingerprints of one key than a block holds: the same components as brute force."""
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 16)
    draw = np.random.default_rng(4)
    base = [int(draw.integers(0, 1 << 63)) for _ in range(4)]
    values = {b ^ sum(1 << int(p) for p in draw.choice(20, draw.integers(0, 4))) for b in base for _ in range(60)}
    values = sorted(values)
    frame = spark.createDataFrame([(i, struct.unpack("q", struct.pack("Q", v))[0]) for i, v in enumerate(values)], "doc_id long, fp long")
    links = simhash.near_links(frame.select("fp"), 2)
    from tidemart.llm.components import components

    named = components(links.where("true")).collect()
    mine = {}
    for r in named:
        mine.setdefault(r.component, set()).add(r.node & (1 << 64) - 1)
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    theirs = {}
    for i, v in enumerate(values):
        theirs.setdefault(find(i), set()).add(v)
    assert sorted(map(sorted, mine.values())) == sorted(sorted(g) for g in theirs.values() if len(g) > 1)


def test_one_of_each_component_stays(odd, nothing):
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    # The two texts of 5 same words differ in one shingle of four, beyond two bits.
    assert ids(kept) == [None, 1, 3, 6, 7, 8, 9]
    assert simhash.keep_one_of_each(nothing).count() == 0


def test_long_pre_tokens(spark):
    """A megabyte without white space is encoded within seconds, and as the library does."""
    import time

    from tokenizers import Tokenizer

    path = queries.tokenizer(queries.BYTE_BPE)
    draw = np.random.default_rng(8)
    texts = ["a" * 5_001, "ab" * 3_000, "".join(draw.choice(list("etaoinshr"), 9_000)), "é" * 4_000 + "1" * 4_000]
    library, model = Tokenizer.from_file(path), bpe.load(path)
    for text in texts:
        assert model.encode(text) == library.encode(text, add_special_tokens=False).ids
    started = time.monotonic()
    ids_ = model.encode("".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 1 << 20)))
    assert time.monotonic() - started < 60 and len(ids_) > 1 << 18


def test_remembered_stretches_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 100_000)
    memory = bpe.Memory()
    for i in range(5_000):
        memory.put(str(i), (str(i), b"x"))
        memory.turn()
    assert 0 < len(memory.now) + len(memory.before) < 2 * 100_000 / bpe.ENTRY_BYTES + 2


def test_byte_bpe(odd, nothing):
    path = queries.tokenizer(queries.BYTE_BPE)
    rows = collected(bpe.digest_documents(odd, path))
    assert [r.doc_id for r in rows] == IDS
    empty = next(r for r in rows if r.doc_id == 3)
    assert (empty.n_tokens, empty.ids_sha256) == (0, hashlib.sha256(b"").hexdigest())
    encoded = bpe.encode_documents(odd, path)
    texts = Counter((r[0], r[1] or "") for r in ODD_ROWS)
    assert Counter((r.doc_id, r.text) for r in bpe.decode_documents(encoded, path).collect()) == texts
    assert bpe.digest_documents(nothing, path).count() == 0


def test_token_counts(odd, nothing):
    path = queries.tokenizer(queries.PIECE_BPE)
    rows = collected(token_counts.count_tokens(odd, path))
    assert [r.doc_id for r in rows] == IDS
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[3].n_bytes, by_id[3].n_tokens, by_id[3].over_limit) == (0, 0, False)
    assert by_id[7].over_limit
    assert token_counts.count_tokens(nothing, path).count() == 0


def test_token_counts_of_small_blocks_and_segments(odd, monkeypatch):
    """Each distinct pre-token is counted in one segment, whatever the blocks; the same totals."""
    path = queries.tokenizer(queries.PIECE_BPE)
    whole = sorted(map(tuple, token_counts.count_tokens(odd, path).collect()), key=repr)
    monkeypatch.setattr(token_counts, "CHUNK_CHARS", 30)
    assert sorted(map(tuple, token_counts.count_tokens(odd.repartition(3), path, segment_words=2).collect()), key=repr) == whole
    blocks = token_counts.frequency_blocks(odd.repartition(3), path)
    asked = token_counts.word_requests(blocks, 7).collect()
    place = {}
    for r in asked:
        for w in token_counts._unpack_words(r.data, r.n):
            assert place.setdefault(w, r.segment) == r.segment
    assert len({r.block for r in asked}) > 3


def test_token_files(spark, odd, nothing, tmp_path):
    path = queries.tokenizer(queries.WORD_BPE)
    manifest = token_files.write_token_files(odd, path, f"file://{tmp_path}/files")
    rows = token_files.read_documents(manifest, token_files.checksums, "ids_crc32 long").orderBy("start").collect()
    assert [r.doc_id for r in rows] == IDS
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    parts = manifest.orderBy("part").collect()
    for part in parts:
        tokens = np.fromfile(part.tokens.removeprefix("file://"), dtype=part.dtype)
        offsets = np.fromfile(part.offsets.removeprefix("file://"), dtype="<u8")
        assert len(tokens) == part.n_tokens == offsets[-1] and len(offsets) == part.n_docs + 1
        assert all(tokens[e - 1] == token_files.END_ID for e in offsets[1:].astype(int))
    assert token_files.round_trip(nothing, path).count() == 0


def test_lm_scores(odd, nothing):
    rows = collected(lm.score_documents(odd))
    assert [r.doc_id for r in rows] == IDS
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert all(r.score <= 0 and np.isfinite(r.base_score) for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    assert lm.score_documents(nothing).count() == 0


def test_counts_in_the_filter():
    draw = np.random.default_rng(3)
    grams = np.unique(draw.integers(0, 1 << 63, 20_000).astype(np.uint64))
    counts = np.minimum(draw.zipf(1.6, len(grams)), 10**6)
    segment, keys = lm.located(grams, 4)
    bits = 8 * (len(grams) * 10)
    levels = lm.levels_of(counts)
    data = np.concatenate([lm.filled(bits, keys[segment == s], levels[segment == s]) for s in range(4)])
    held = lm.CountFilter(bits, 4, data)
    found = held.levels(grams)
    assert (found >= levels).all() and (found == levels).mean() > 0.97
    unseen = np.setdiff1d(draw.integers(0, 1 << 63, 20_000).astype(np.uint64), grams)
    assert (held.levels(unseen) > 0).mean() < 0.02
    packed = lm._packed(np.sort(keys[:100]), counts[:100])
    assert np.array_equal(np.sort(lm._unpacked(packed)[1]), np.sort(counts[:100]))


def test_no_ngram_is_left_out_of_the_filter(spark):
    """Where every word is new, each n-gram of a training text still has its count of 1."""
    texts = [" ".join(f"w{d}x{i}" for i in range(400)) for d in range(60)]
    frame = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in enumerate(texts)], DOCUMENTS).repartition(3)
    rows = lm.score_documents(frame).collect()
    n = rows[0].train_tokens
    learned = [r for r in rows if not r.held_out]
    assert n == 401 * len(learned) and len(rows) == 60 > len(learned) > 30
    bottom = n + 0.5 * (400 * len(learned) + 2)
    exact = 400 * np.log10((1 + lm.MU * 1.5 / bottom) / (1 + lm.MU))
    # Apart from the words: the first follows START, and the end follows the last word.
    assert all(r.score == pytest.approx(exact, rel=0.05) for r in learned)
    assert all(r.score < 1.3 * exact for r in rows if r.held_out)


def test_parsing(odd, nothing):
    rows = collected(parsing.compare_edited(odd))
    assert [r.doc_id for r in rows] == IDS
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    prints = {}
    for r in parsing.fingerprint_documents(odd).collect():
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[1] == prints[2] and len(prints[2]) == 1 and prints[3] == prints[4]
    assert parsing.compare_edited(nothing).count() == 0
    single = parsing.compare_edited(odd.where("doc_id = 1")).first()
    assert single.near_next == 1.0


def test_equal_substrings_share_signatures():
    draw = np.random.default_rng(5)
    text = "".join(chr(int(c)) for c in draw.integers(97, 110, 6000))
    moved = parsing.fingerprints([text, "zz" + text + "yyy"])
    other = parsing.fingerprints(["".join(chr(int(c)) for c in draw.integers(97, 110, 6000))])
    assert parsing.likeness(*moved) > 0.8
    assert parsing.likeness(moved[0], other[0]) < 0.3


VECTORS = "vec_id long, embedding array<float>, score string"


def test_top_k(spark):
    draw = np.random.default_rng(6)
    rows = [(i, [float(x) for x in draw.normal(size=6)], "x") for i in range(120)]
    same = [(200 + i, rows[0][1], "x") for i in range(40)]
    odd = [(300, None, "x"), (301, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x"), (302, [float("nan")] * 6, "x"), (None, rows[1][1], "x")]
    odd += [(303, [1.0, 2.0], "x"), (350, [float("inf")] * 6, "x"), (400, [3e18, -3e18, 1.0, 0.0, 0.0, 0.0], "x"), (7, rows[7][1], "x")]
    frame = spark.createDataFrame(rows + same + odd, VECTORS).repartition(5)
    found = topk.top_k(frame, frame.where("vec_id % 50 = 0"), 5).collect()
    valid = [(i, [int(np.floor(256.0 * np.float64(np.float32(x)))) for x in v]) for i, v, _ in rows + same + odd if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    expected = []
    for q, v in valid:
        if q % 50 == 0:
            products = [(sum(a * b for a, b in zip(v, w)), i) for i, w in valid if i != q and len(w) == len(v)]
            scores = [(-min(max(s, -(1 << 63)), (1 << 63) - 1), i) for s, i in products]
            expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:5], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == sorted(expected)
    none = spark.createDataFrame([], VECTORS)
    assert topk.top_k(none, none).count() == 0
    few = spark.createDataFrame(rows[:3], VECTORS)
    assert topk.top_k(few, few.where("vec_id = 0"), 5).count() == 2


def test_toxicity(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (7, 0), (8, None), (None, 1), (9, 0)], LABELS)
    model = toxicity.learn(odd, toxicity.training_labels(labels, folds=1, held=1))
    rows = collected(toxicity.score_toxicity(odd, model))
    assert [r.doc_id for r in rows] == IDS and all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.keep_clean(odd, model)
    assert kept.columns == odd.columns
    assert toxicity.score_toxicity(nothing, model).count() == 0
    unlabelled = toxicity.learn(odd, labels.where("false"))
    assert {r.score for r in toxicity.score_toxicity(odd, unlabelled).collect()} == {0.0}


def test_maximal_segments_by_brute_force():
    draw = np.random.default_rng(8)
    for _ in range(300):
        n = int(draw.integers(1, 30))
        weights = [float(x) if draw.random() < 0.3 else -0.5 for x in draw.uniform(0.2, 3, n)]
        places = [i for i, w in enumerate(weights) if w > 0]
        found = toxicity.maximal_segments(places, [weights[i] for i in places], -0.5)

        def split(a, b):
            """The definition: the best segment (shortest of equals), then both sides of it."""
            best = max(((sum(weights[i:j]), i - j, -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
            if best is None or best[0] <= 1e-12:
                return []
            _, _, _, i, j = best
            return split(a, i) + [(i, j, sum(weights[i:j]))] + split(j, b)

        wanted = split(0, n)
        assert [f[:2] for f in found] == [w[:2] for w in wanted]
        assert [f[2] for f in found] == pytest.approx([w[2] for w in wanted])


def test_pipeline_stages_on_an_empty_table(spark, nothing, tmp_path):
    from tidemart.llm.stages import STAGES

    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in STAGES[:-1]:
        result = stage(spark, nothing, str(tmp_path))
        assert result.columns == nothing.columns and result.count() == 0
    assert STAGES[-1][1](spark, nothing, str(tmp_path)).count() == 0


def test_pipeline_keeps_clean_documents(spark, given):
    """Each stage removes what it should and keeps the rest, in the order given."""
    from tidemart.llm.stages import STAGES, run
    from tidemart.llm.common import saved

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r["doc_id"]: r["toxic"] for r in given("labels")}
    steps = {"start": docs}
    for label, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, SF), "stage")
        steps[label] = docs
    names = list(steps)
    rows = {n: steps[n].count() for n in names}
    assert steps["language ID"].count() >= 0.97 * rows["start"]
    after = set(ids(steps["toxicity"]))
    gone = set(ids(steps["language ID"])) - after
    assert sum(toxic.get(i) == 0 for i in gone) <= 0.1 * max(1, len(gone))
    component = simhash_components({r.doc_id: r.text for r in steps["toxicity"].collect()})
    assert ids(steps["simhash near-dedup"]) == sorted(set(component.values()))
    final = run(spark, SF)
    assert final.count() == steps["mixing"].count() and final.where(F.col("n_tokens").isNull()).count() == 0
