"""Token alignment against brute force over all pairs of tokens."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from text_rows import DOCUMENTS, ODD_ROWS

from tidemart.llm import alignment, queries
from tidemart.llm.bpe import printable_bytes

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
PATHS = (queries.tokenizer(queries.BYTE_BPE), queries.tokenizer(queries.PIECE_BPE))


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def brute_force(rows, libraries):
    """Rows (doc_id, text) -> sorted rows of the contract, from the ranges of all tokens."""
    first, second = libraries
    byte_of = printable_bytes()

    def ranges(pieces):
        out, at = [], 0
        for i, data in pieces:
            out.append((i, at, at + len(data)))
            at += len(data)
        return out, b"".join(d for _, d in pieces)

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("\u2581", " ").encode()

    documents = []
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        a, joined_a = ranges([(i, bytes(byte_of[c] for c in first.id_to_token(i))) for i in first.encode(whole.decode(), add_special_tokens=False).ids])
        b, joined_b = ranges([(i, piece(i)) for i in second.encode(text or "")])
        if not text or joined_a != whole or joined_b != whole:
            a = b = []
        links, at = [], 0
        for i, start, end in a:
            while at < len(b) and b[at][2] <= start:
                at += 1
            near = at
            while near < len(b) and b[near][1] < end:
                links.append((i, b[near][0]))
                near += 1
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, at = [], [0, 0]
        for end in ends:
            sides = []
            for k, side in enumerate((a, b)):
                begin = at[k]
                while at[k] < len(side) and side[at[k]][2] <= end:
                    at[k] += 1
                sides.append(",".join(str(i) for i, *_ in side[begin : at[k]]))
            groups.append("|".join(sides))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        documents.append((doc, len(a), len(b), len(ends), links, digest))
    counts = Counter(p for d in documents for p in d[4])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc, n_a, n_b, n_groups, links, digest in documents:
        n_best = sum(counts[p] == best[p[1]] for p in links)
        out.append((doc, n_a, n_b, n_groups, len(links), n_best, sum(counts[p] for p in links), digest))
    return sorted(out, key=repr)


def collected(rows):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=repr)


def test_query_equals_brute_force(results, given, libraries):
    rows = [(d["doc_id"], d["text"]) for d in given("documents")]
    assert collected(results("op11_alignment")) == brute_force(rows, libraries)


def test_odd_texts(spark, odd, nothing, libraries, monkeypatch):
    """Also where blocks are small and segments many."""
    strange = [(20, "a\u2581b"), (21, " lead  and  trail "), (22, "\U0001f600\u0301 x\x00y"), (23, "<s></s><|endoftext|>"), (24, "\ufb01 \u2460"), (25, "tab\tline\r\n")]
    rows = [(r[0], r[1]) for r in ODD_ROWS] + strange
    frame = odd.select("doc_id", "text").union(spark.createDataFrame(strange, "doc_id long, text string"))
    wanted = brute_force(rows, libraries)
    assert collected(alignment.align_documents(frame.withColumn("block", F.lit(1)), *PATHS).collect()) == wanted
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 40)
    monkeypatch.setattr(alignment, "SEGMENT_PAIRS", 5)
    assert collected(alignment.align_documents(frame.repartition(3), *PATHS).collect()) == wanted
    assert alignment.align_documents(nothing, *PATHS).count() == 0


def test_long_text_in_parts(libraries, monkeypatch):
    """A text of many parts has the figures of the whole one."""
    model = alignment.load(*PATHS)
    texts = ["one two  three, four\nfive six 7 eight", "a b c d e f g h i j", "", "\u2581 bad parts here as well", "gr\u00fc\u00df dich \u00e9\u00e8 ok"]
    whole = alignment.align(model, texts)
    monkeypatch.setattr(alignment, "PART_CHARS", 3)
    assert len(model.parts(texts[0])) == 3
    cut = alignment.align(model, texts)
    assert all(list(cut[c]) == list(whole[c]) for c in (*alignment.FIGURES, "groups_sha256"))
    assert (cut["links"] == whole["links"]).all()
    monkeypatch.undo()
    text = "The quick brown fox, 12 x; jumps \u00fcber den Zaun. " * 40_000
    assert len(model.parts(text)) > 2 and " ".join(model.parts(text)) == text
    found = alignment.align(model, [text])
    assert found["n_a"][0] == len(libraries[0].encode(" " + text, add_special_tokens=False).ids)
    assert found["n_b"][0] == len(libraries[1].encode(text))
    assert found["links"][:, 2].sum() == found["n_links"][0] == found["n_a"][0] + found["n_b"][0] - found["n_groups"][0]


def test_both_forms_of_the_first_tokenizer_agree(libraries):
    """Each token of the vocabulary as a text, odd texts, and words too long for the faster form."""
    model = alignment.load(*PATHS)
    assert model.ranked is not None
    texts = [b.decode() for b in model.first_bytes if b.decode(errors="ignore").encode() == b]
    texts += [r[1] or "" for r in ODD_ROWS] + ["y" * 900 + " z", "a\u00a0b\u2003 c\u3000d\x85e\x1cf", "it's WE'LL \u02bcs 1\u00b2\u2167"]
    for text in texts:
        assert model.first_ids(text) == libraries[0].encode(" " + text, add_special_tokens=False).ids, text
