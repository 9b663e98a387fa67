"""Each numbered query over the smallest tables against a brute-force form or SQL."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from text_rows import SF, simhash_components, simhash_print, words

from tidemart.llm import language, lm, parsing, queries, sql, toxicity


def crc(key, folds):
    return zlib.crc32(str(key).encode()) % folds


@pytest.mark.parametrize("name", list(sql.oracle_sql()))
def test_query_equals_sql(results, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = connection.sql(sql.oracle_sql()[name])
    columns = sorted(expected.columns)
    theirs = sorted(repr([dict(zip(expected.columns, r))[c] for c in columns]) for r in expected.fetchall())
    mine = sorted(repr([r[c] for c in columns]) for r in results(name))
    assert mine and mine == theirs


def test_languages_of_held_out_documents(results, given):
    lang = {d["doc_id"]: d["lang"] for d in given("documents")}
    rows = results("op1_language_id")
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in lang if crc(i, 5) == 0}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_mix_is_near_its_targets(results, given):
    source = {d["doc_id"]: d["source"] for d in given("documents")}
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in results("op2_mix_sources"):
        name = source[r["doc_id"]]
        taken[name] += r["taken"]
        target[name] = r["target"]
        largest[name] = max(largest[name], r["size"])
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert math.isclose(sum(target.values()), sum(r["size"] for r in results("op2_mix_sources")), rel_tol=1e-9)
    assert all(abs(taken[n] - target[n]) <= 1.5 * largest[n] for n in target)


def test_simhash_components(results, given):
    texts = {d["doc_id"]: d["text"] for d in given("documents")}
    rows = results("op3_simhash")
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{simhash_print(t):016x}" for i, t in texts.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == simhash_components(texts)


def test_byte_bpe(results, given):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer(queries.BYTE_BPE))
    expected = []
    for d in given("documents"):
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text)]
        expected.append((d["doc_id"], len(ids), *digests))
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(tuple(r[c] for c in columns) for r in results("op4_byte_bpe")) == sorted(expected)


def test_token_counts(results, given):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer(queries.PIECE_BPE))
    expected = []
    for d in given("documents"):
        n = len(model.encode(d["text"] or ""))
        expected.append((d["doc_id"], len((d["text"] or "").encode()), n, n > 4096))
    columns = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert sorted(tuple(r[c] for c in columns) for r in results("op5_token_counts")) == sorted(expected)


def test_token_files(results, given):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer(queries.WORD_BPE))
    expected, start = [], 0
    for d in sorted(given("documents"), key=lambda d: d["doc_id"]):
        ids = [*library.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        expected.append((d["doc_id"], start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    columns = ("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(tuple(r[c] for c in columns) for r in results("op6_token_files")) == expected


def test_base_scores_and_the_model(results, given):
    docs = given("documents")
    tokens = {d["doc_id"]: [*words(d["text"]), None] for d in docs}
    counts = Counter(t for i, ts in tokens.items() if crc(i, 5) != 1 for t in ts)
    n, v = sum(counts.values()), len(counts)
    rows = {r["doc_id"]: r for r in results("op7_lm_scores")}
    assert rows.keys() == tokens.keys()
    for i, ts in tokens.items():
        row = rows[i]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (crc(i, 5) == 1, len(ts), n)
        assert row["n_known"] == sum(counts[t] > 0 for t in ts)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)
        assert math.isfinite(row["score"]) and row["score"] < 0
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_by_brute_force(results, given):
    """The model's formula over exact counts cut to their levels; only false levels of the filter may part them."""
    docs = given("documents")
    tokens = {d["doc_id"]: [*words(d["text"]), None] for d in docs}
    learned = [ts for i, ts in tokens.items() if crc(i, 5) != 1]
    ones = Counter(t for ts in learned for t in ts) + Counter({"": len(learned)})
    twos = Counter(p for ts in learned for p in zip(["", *ts], ts))
    n = sum(map(len, learned))
    bottom = n + 0.5 * (len(ones) - 1 + 1)

    def estimate(counts):
        return lm.LEVEL_COUNT[lm.levels_of(np.array(counts, dtype=np.int64))]

    apart = []
    for row in results("op7_lm_scores"):
        ts = tokens[row["doc_id"]]
        pairs = list(zip(["", *ts], ts))
        before = estimate([ones[v] for v, _ in pairs])
        alone = np.minimum((estimate([ones[w] for _, w in pairs]) + 0.5) / bottom, 1)
        both = np.minimum(estimate([twos[p] for p in pairs]), before)
        expected = np.log10(np.minimum(1, (both + lm.MU * alone) / (before + lm.MU))).sum()
        apart.append(abs(row["score"] - expected) / -expected)
    assert np.mean(apart) < 0.005 and np.mean(np.array(apart) < 0.02) > 0.95


def test_segments_follow_the_tokens(spark, odd, monkeypatch):
    """Many small segments give the counts that one gives."""
    def rows():
        found = lm.score_documents(odd).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score")
        return sorted(map(tuple, found.collect()), key=str)

    whole = rows()
    monkeypatch.setattr(lm, "SEGMENT_TOKENS", 1000)
    assert rows() == whole


def test_parsing_fingerprints(results, given):
    docs = sorted(given("documents"), key=lambda d: d["doc_id"])
    rows = {r["doc_id"]: r for r in results("op8_parsing_fingerprints")}
    for d, following in zip(docs, docs[1:] + docs[:1]):
        text, other = d["text"] or "", following["text"] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + other[:half]
        row = rows[d["doc_id"]]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        own, edit, nxt = (parsing.fingerprints([t])[0] for t in (text, changed, other))
        assert (row["fingerprint"], row["edited_fingerprint"]) == (own, edit)
        assert math.isclose(row["near_edited"], parsing.likeness(own, edit))
        assert math.isclose(row["near_next"], parsing.likeness(own, nxt))
    different = [r for r in rows.values() if r["n_chars"] > 500 and r["near_edited"] < 1]
    assert np.mean([r["near_edited"] > r["near_next"] for r in different]) > 0.9


def test_toxicity_of_held_out_documents(results, given):
    toxic = {r["doc_id"]: r["toxic"] for r in given("labels")}
    rows = results("op10_toxicity")
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= toxicity.THRESHOLD) for r in rows)
    assert {r["doc_id"] for r in rows if r["held_out"]} == {r["doc_id"] for r in rows if crc(r["doc_id"], 4) == 2}
    marked = [r for r in rows if r["doc_id"] in toxic]
    right = sum(r["predicted"] == toxic[r["doc_id"]] for r in marked)
    assert right >= 0.9 * len(marked)


def test_und_needs_no_model():
    assert language.LanguageModel({}, [], {}).predict(["text"]) == [(language.UNKNOWN, 0.0)]
