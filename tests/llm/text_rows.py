"""Rows and places the text operators' tests share, and brute-force forms."""

import xxhash

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

# Nulls in every column, empty and white texts, a very long one, ties and repeated rows.
ODD_ROWS = [
    (1, "One two three four five six", "en", "a", 27),
    (2, "One two three four five six", "en", "a", 27),
    (2, "One two three four five six", "en", "a", 27),
    (None, "One two three four five seven", None, None, None),
    (3, None, "en", "a", None),
    (4, "", "de", None, 0),
    (5, " \t\n", None, "b", 3),
    (6, "12 34 !?", "fr", "b", 8),
    (7, "éa é " * 30_000, "fr", "b", 150_000),
    (8, "x" * 70_000, "de", "a", 70_000),
    (9, "<|endoftext|> end <s>", "es", "c", 21),
]


def words(text):
    return (text or "").encode().lower().split()


def components(ids, linked):
    """The smallest id reachable from each over all pairs for which ``linked`` holds."""
    ids = sorted(ids)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def simhash_print(text):
    own = words(text)
    shingles = [b" ".join(own[i : i + 3]) for i in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(texts):
    prints = {i: simhash_print(t) for i, t in texts.items()}
    return components(prints, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
