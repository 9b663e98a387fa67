"""The conversation trie against brute force over all prefixes."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_force(rows):
    """Rows (conv_id, turn, role, text) -> sorted rows of the contract."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = abs(c) // 100 * 100 * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, savings = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[c] for c in below) if below else 1
        savings[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(savings[c] for c in below)
    out = []
    for p, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if whole[c] == p)
        parent = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(p), parent, len(convs), len(children.get(p, [])), leaves[p], savings[p], digest))
    return sorted(out, key=repr)


def collected(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


def drawn(seed):
    """Families that share turns, copies of conversations, one long conversation twice, short ones, odd values."""
    draw = np.random.default_rng(seed)
    rows = []
    for c in draw.choice(np.arange(-250, 1200), 120, replace=False).tolist():
        length = int(draw.integers(1, 9))
        for t in range(length):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"t{int(draw.integers(0, 2))}" * int(draw.integers(1, 3))))
    for c in (5000, 5001, 7100):
        rows += [(c, t, "user", f"long {t}" if t < 280 or c != 5001 else f"other {t}") for t in range(300)]
    rows += [(1, None, None, None), (1, None, "user", ""), (1, 0, "user", "x"), (1, 0, "user", "x"), (None, 0, "user", "lost")]
    rows += [(c, 0, "user", "same") for c in range(3000, 3040)]
    return rows


@pytest.mark.parametrize("shard_nodes", [7, 60, 1 << 19])
def test_trie_equals_brute_force(spark, shard_nodes):
    rows = drawn(5)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumns({c: F.lit("x") for c in ("depth", "part", "path", "k1", "base")}).repartition(9)
    found = trie.conversation_trie(frame, shard_nodes)
    assert collected(found) == brute_force(rows)


def test_one_conversation_and_none(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(100, t, "user", "ab") for t in range(70)]
    assert collected(trie.conversation_trie(spark.createDataFrame(rows, schema))) == brute_force(rows)
    assert trie.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    # Rebuilding leaves this one without a turn.
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(alone, 0, "user", "gone")]
    assert collected(trie.conversation_trie(spark.createDataFrame(rows, schema))) == brute_force(rows)


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 5000])
def test_find_close(n):
    draw = np.random.default_rng(n)
    bits, stack, close = [], [], {}
    opened = 0
    while opened < n or stack:
        if opened < n and (not stack or draw.random() < 0.55):
            stack.append(len(bits))
            bits.append(1)
            opened += 1
        else:
            close[stack.pop()] = len(bits)
            bits.append(0)
    tree = trie.Parentheses(np.array(bits))
    opens = np.flatnonzero(tree.bits == 1)
    assert tree.find_close(opens).tolist() == [close[i] for i in opens]
