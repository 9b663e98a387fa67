"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A text is cut at special tokens, then into pre-tokens; merges never leave a
pre-token. For each pre-token a segment tree holds ``rank, place`` of every
adjacent pair, the smaller key winning at each node: the root is the leftmost pair of
the lowest rank. A merge changes the pair itself and its two neighbours, three
leaves, each updated along its path to the root; the pre-token is done when the
root is empty. Trees of equal depth are worked on together as arrays, one merge
per tree and step, and each distinct stretch of text is encoded once per batch (and
remembered for the task, within two generations of ``REMEMBERED_BYTES``). A long pre-token has a tree of
its own; as no merge rule uses a piece before the rule that makes it, all places of the
lowest rank are found by one descent from the root and merged in one step, left to right.

Defined results: a NULL text is encoded as the empty one; no token, ids "" and
text "" for it. Repeated rows are separate rows; an empty table gives an empty
result; extra columns are ignored. A pre-token of n bytes takes ``O(n log n)`` for its merges and
``O(log n)`` for each distinct rank among them; a megabyte without white space is a matter of seconds.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemart.llm.common import map_batches, narrow, text_chunks

CHUNK_CHARS = 1 << 22
REMEMBERED_BYTES = 16 << 20
# Size of the objects of a remembered stretch besides their characters.
ENTRY_BYTES = 280
LONG_DEPTH = 11
NONE = np.int64(1 << 62)
PLACE_BITS = 40
# Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies.

    Bytes that print as themselves keep their code point; the others follow
    from 256 on, in byte order.
    """
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Memory:
    """Results by stretch, in two generations.

    When the newer one is full it becomes the older; an entry met again moves
    back to the newer, so frequent stretches stay and the size is bounded.
    """

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.now: dict[str, tuple[str, bytes] | None] = {}
        self.before: dict[str, tuple[str, bytes] | None] = {}
        self.size = 0

    def missing(self, stretches: list[str]) -> list[str]:
        new = set(stretches).difference(self.now)
        if not new:
            return []
        found = [s for s in new if s in self.before]
        for s in found:
            self.put(s, self.before[s])
        return list(new.difference(found))

    def put(self, stretch: str, entry: tuple[str, bytes] | None) -> None:
        self.now[stretch] = entry
        self.size += ENTRY_BYTES + len(stretch) + (len(entry[0]) + len(entry[1]) if entry else 0)

    def turn(self) -> None:
        if self.size > REMEMBERED_BYTES:
            self.now, self.before, self.size = {}, self.now, 0


class ByteBpe:
    """A byte-level BPE vocabulary read from a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, byte_of = spec["model"], printable_bytes()
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            if token not in self.special:
                self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.first_ids = np.zeros(256, dtype=np.int64)
        for char, byte in byte_of.items():
            self.first_ids[byte] = vocab[char]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        codes = np.array([vocab[a] * size + vocab[b] for a, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.size = size
        self._index(codes)
        # The last rule that makes each id: whether all rules that use an id come later.
        last = np.full(size, -1, dtype=np.int64)
        last[self.merged] = np.arange(len(codes))
        used = np.arange(len(codes))
        self.in_order = bool(((last[codes // size] < used) & (last[codes % size] < used)).all())
        self.pattern = regex.compile(PATTERN)
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.number = [str(i) for i in range(size)]
        self.bare, self.spaced = Memory(), Memory()

    # --- encoding

    def _index(self, codes: np.ndarray) -> None:
        """An open-addressing table of pair codes: slot -> (code, rank)."""
        self.bits = 2 + int(len(codes)).bit_length()
        slots = 1 << self.bits
        self.slot_code = np.full(slots, -1, dtype=np.int64)
        self.slot_rank = np.zeros(slots, dtype=np.int64)
        rank, at, self.probes = np.arange(len(codes)), self._slot(codes), 0
        while len(rank):
            self.probes += 1
            free = self.slot_code[at] < 0
            taken = at[free]
            self.slot_code[taken], self.slot_rank[taken] = codes[rank[free]], rank[free]
            # Of several codes for one slot the last one written stays; the others go on.
            lost = self.slot_code[at] != codes[rank]
            rank, at = rank[lost], (at[lost] + 1) & (slots - 1)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def keys(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """rank and place of each pair as one number; NONE where the pair does not merge."""
        code = left * self.size + right
        code = np.where((left < 0) | (right < 0), -2, code)
        at = self._slot(code)
        out = np.full(code.shape, NONE, dtype=np.int64)
        for _ in range(self.probes):
            held = self.slot_code.take(at)
            hit = held == code
            out = np.where(hit, (self.slot_rank.take(at) << PLACE_BITS) | place, out)
            if not ((held >= 0) & ~hit).any():
                break
            at = (at + 1) & (len(self.slot_code) - 1)
        return out

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each byte string, by segment trees grouped by depth."""
        out: list[list[int]] = [[]] * len(words)
        depths: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            depths.setdefault(max(1, (len(word) - 1).bit_length()), []).append(i)
        for depth, members in depths.items():
            if depth > LONG_DEPTH:
                for i in members:
                    out[i] = self._merge_long(words[i], depth)
                continue
            # Few enough leaves at a time for the arrays to stay in the processor's cache.
            step = max(1, (1 << 16) >> depth)
            for start in range(0, len(members), step):
                part = members[start : start + step]
                for i, ids in zip(part, self._merge_alike([words[i] for i in part], depth)):
                    out[i] = ids
        return out

    def _merge_alike(self, words: list[bytes], depth: int) -> list[list[int]]:
        """Merge words of at most ``2 ** depth`` bytes; all arrays are flat, one stretch per word."""
        n, leaves = len(words), 1 << depth
        lengths = np.array([len(w) for w in words])
        padded = np.frombuffer(b"".join([w.ljust(leaves, b"\0") for w in words]), dtype=np.uint8).reshape(n, leaves)
        places = np.arange(leaves)
        # Two more columns: before the first and beyond the last symbol stands -1.
        wide = leaves + 2
        symbols = np.full((n, wide), -1, dtype=np.int64)
        symbols[:, 1:-1] = np.where(places < lengths[:, None], self.first_ids[padded], -1)
        tree = np.full((n, 2 * leaves), NONE, dtype=np.int64)
        tree[:, leaves:] = self.keys(symbols[:, 1:-1], symbols[:, 2:], places[None, :])
        for level in range(depth - 1, -1, -1):
            low = 1 << level
            tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
        column = np.arange(wide)
        after = np.tile(np.minimum(column + 1, leaves + 1), n)
        before = np.tile(np.maximum(column - 1, 0), n)
        symbols, tree = symbols.ravel(), tree.ravel()
        active = np.arange(n)
        while True:
            root = tree.take(active * (2 * leaves) + 1)
            live = root != NONE
            if not live.all():
                active, root = active[live], root[live]
            if not len(active):
                break
            row, top = active * wide, active * (2 * leaves)
            place = (root & ((1 << PLACE_BITS) - 1)) + 1
            gone = after.take(row + place)
            follows = after.take(row + gone)
            previous = before.take(row + place)
            merged = self.merged.take(root >> PLACE_BITS)
            symbols[row + place] = merged
            symbols[row + gone] = -1
            after[row + place] = follows
            before[row + follows] = place
            own = self.keys(merged, symbols.take(row + follows), place - 1)
            earlier = self.keys(symbols.take(row + previous), merged, previous - 1)
            # The pair that began at the swallowed symbol is gone, the pair itself and the one
            # before it have new ranks. A first symbol has no pair before it.
            first = previous == 0
            points = [(gone - 1, np.broadcast_to(NONE, len(row))), (place - 1, own)]
            points.append((np.where(first, place - 1, previous - 1), np.where(first, own, earlier)))
            for leaf, key in points:
                node = leaf + leaves
                tree[top + node] = key
            for leaf, _ in points:
                node = leaf + leaves
                for _ in range(depth):
                    node = node >> 1
                    at = top + node
                    child = at + node
                    tree[at] = np.minimum(tree.take(child), tree.take(child + 1))
        kept = symbols >= 0
        ends = np.cumsum(kept.reshape(n, wide).sum(axis=1)).tolist()
        ids = symbols[kept].tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_long(self, word: bytes, depth: int) -> list[int]:
        """Merge one word by its own tree, all places of the lowest rank in a step."""
        n, leaves = len(word), 1 << depth
        # The place after the last symbol, and the one before the first (index -1), hold no symbol.
        symbols = np.full(n + 2, -1, dtype=np.int64)
        symbols[:n] = self.first_ids[np.frombuffer(word, dtype=np.uint8)]
        after = np.minimum(np.arange(1, n + 3), n)
        before = np.arange(-1, n + 1)
        tree = np.full(2 * leaves, NONE, dtype=np.int64)
        tree[leaves : leaves + n] = self.keys(symbols[:n], symbols[1 : n + 1], np.arange(n))
        for level in range(depth - 1, -1, -1):
            low = 1 << level
            tree[low : 2 * low] = np.minimum(tree[2 * low : 4 * low : 2], tree[2 * low + 1 : 4 * low : 2])
        while tree[1] != NONE:
            rank = tree[1] >> PLACE_BITS
            if self.in_order:
                at = np.ones(1, dtype=np.int64)
                for _ in range(depth):
                    at = np.repeat(2 * at, 2)
                    at[1::2] += 1
                    at = at[tree[at] >> PLACE_BITS == rank]
                at -= leaves
                # Of overlapping places (runs of one symbol) every second one, from the left.
                begins = np.concatenate([[True], after[at[:-1]] != at[1:]])
                number = np.arange(len(at))
                at = at[(number - np.maximum.accumulate(np.where(begins, number, 0))) % 2 == 0]
            else:
                at = np.array([tree[1] & ((1 << PLACE_BITS) - 1)])
            gone = after[at]
            follows = after[gone]
            symbols[at], symbols[gone] = self.merged[rank], -1
            after[at], before[follows] = follows, at
            left = before[at]
            left = left[left >= 0]
            changed = np.concatenate([at, left])
            tree[gone + leaves] = NONE
            tree[changed + leaves] = self.keys(symbols[changed], symbols[after[changed]], changed)
            node = np.unique(np.concatenate([gone, changed])) + leaves
            for _ in range(depth):
                node = node >> 1
                node = node[np.concatenate([[True], node[1:] != node[:-1]])]
                tree[node] = np.minimum(tree[2 * node], tree[2 * node + 1])
        return symbols[symbols >= 0].tolist()

    def forget(self) -> None:
        self.bare.clear()
        self.spaced.clear()

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens and special tokens of a text, in order."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.pattern.findall(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out += [part] if part in self.special else self.pattern.findall(part)
        return out

    def parts(self, text: str) -> tuple[list[str], list[str]]:
        """A text as bare stretches and stretches that follow a space, in that order.

        A single space between two characters that are no white space always
        begins a pre-token, so texts are cut at spaces and only distinct stretches
        are cut by the pattern. Where that does not hold (``learn`` finds out from the
        stretches), and in texts with special tokens, all pre-tokens are bare.
        """
        if any(s in text for s in self.special):
            return self.pieces(text), []
        bare, spaced = [], text.split(" ")
        if text:
            bare = [spaced.pop(0)]
        else:
            spaced = []
        self.learn(spaced, self.spaced)
        if None in [self.spaced.now[s] for s in spaced] or (spaced and (not bare[0] or bare[0][-1].isspace())):
            return self.pieces(text), []
        return bare, spaced

    def entries(self, text: str) -> list[tuple[str, bytes]]:
        """(decimal ids joined by commas, decoded bytes) of the consecutive stretches of a text."""
        bare, spaced = self.parts(text)
        self.learn(bare, self.bare)
        bare_known, spaced_known = self.bare.now, self.spaced.now
        return [bare_known[s] for s in bare] + [spaced_known[s] for s in spaced]

    def learn(self, stretches: list[str], memory: Memory) -> None:
        """Encode and decode the stretches that are not remembered; None for one that begins or ends in white space."""
        new = memory.missing(stretches)
        if not new:
            return
        joined = [" " + s if memory is self.spaced else s for s in new]
        pieces = [
            [j] if s.isalpha() or s in self.special else self.pieces(j) for s, j in zip(new, joined)
        ]
        merged = iter(self.merge([p.encode() for ps in pieces for p in ps]))
        number, bytes_of = self.number, self.bytes_of
        for stretch, own in zip(new, pieces):
            ids = next(merged) if own else []
            for _ in own[1:]:
                ids = ids + next(merged)
            if memory is self.bare and stretch in self.special:
                ids = [self.special[stretch]]
            if memory is self.spaced and (not stretch or stretch[0].isspace() or stretch[-1].isspace()):
                memory.put(stretch, None)
            else:
                memory.put(stretch, (",".join([number[i] for i in ids]), b"".join([bytes_of[i] for i in ids])))

    def ids_text(self, text: str) -> str:
        """Decimal ids joined by commas."""
        return ",".join([e[0] for e in self.entries(text)])

    def encode(self, text: str) -> list[int]:
        found = self.ids_text(text)
        return list(map(int, found.split(","))) if found else []

    # --- decoding

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """The text of ids, specials included; broken UTF-8 becomes the replacement character."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=1)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every whole text."""

    def listed(texts: list[list[tuple[str, bytes]]]) -> dict:
        joined = [",".join([e[0] for e in entries]) for entries in texts]
        return {"ids": [list(map(int, j.split(","))) if j else [] for j in joined]}

    return _per_text(docs, path, "ids array<int>", listed)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); NULL ids give the empty text."""

    def make():
        bpe = load(path)

        def step(batch: pa.RecordBatch):
            ids = batch.column("ids").to_pylist()
            yield {"doc_id": batch.column("doc_id"), "text": [bpe.decode(i or []) for i in ids]}

        return step

    key = encoded.schema["doc_id"].dataType.simpleString()
    return map_batches(encoded.select("doc_id", "ids"), make, f"doc_id {key}, text string")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, ids kept nowhere."""

    def digests(texts: list[list[tuple[str, bytes]]]) -> dict:
        counts, ids, decoded = [], [], []
        for entries in texts:
            joined = ",".join([e[0] for e in entries])
            counts.append(joined.count(",") + 1 if joined else 0)
            ids.append(hashlib.sha256(joined.encode()).hexdigest())
            whole = b"".join([e[1] for e in entries]).decode("utf-8", errors="replace")
            decoded.append(hashlib.sha256(whole.encode()).hexdigest())
        return {"n_tokens": counts, "ids_sha256": ids, "decoded_sha256": decoded}

    return _per_text(docs, path, "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


def _per_text(docs: DataFrame, path: str, columns: str, result) -> DataFrame:
    rows = narrow(docs)

    def make():
        bpe = load(path)

        def step(batch: pa.RecordBatch):
            ids = batch.column("doc_id")
            for first, texts in text_chunks(batch, CHUNK_CHARS):
                # All new stretches of the chunk at once: the trees are worked on together.
                parted = [t.split(" ") for t in texts]
                bpe.learn([s for p in parted for s in p[1:]], bpe.spaced)
                bpe.learn([p[0] for p in parted], bpe.bare)
                entries = [bpe.entries(t) for t in texts]
                yield {"doc_id": ids.slice(first, len(texts)), **result(entries)}
                bpe.bare.turn()
                bpe.spaced.turn()

        step.done = bpe.forget
        return step

    key = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, make, f"doc_id {key}, {columns}")
