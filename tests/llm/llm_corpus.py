"""Small documents with every oddity, and brute-force versions of what the operators compute."""

import re
from collections import defaultdict

import numpy as np
import xxhash

SCHEMA = "doc_id bigint, text string, lang string, id string, batch string, part string, hit string, count string, fp string"
LONG = " ".join(f"word{i} of a very long text" for i in range(12_000))
PASSAGE = " ".join(f"shared{i}" for i in range(80))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog, and then it sleeps for a long while in the sun."),
    (2, "the QUICK brown fox jumps over the lazy dog, and then it sleeps for a long while in the sun."),
    (3, ""),
    (4, None),
    (5, LONG),
    (6, LONG + " end"),
    (7, "one"),
    (7, "one"),
    (8, "two words"),
    (8, "other text under the same id, which happens"),
    (None, "The quick brown fox jumps over the lazy dog, and then it sleeps for a long while in the sun."),
    (None, None),
    (9, f"first owner {PASSAGE} of the passage"),
    (10, f"second owner {PASSAGE} of it"),
    (11, "ÉCOLE Straße ÀÉ école 日本語 👍🏽 é 　 x\x85y \x1c"),
    (12, "  blanks \n\n and\ttabs  "),
    (13, "ab" * 3000),
    (14, "ab" * 3000 + "x"),
    (15, "a" * 400),
]


def odd_documents(spark, repeat=1):
    rows = [(i, t, None, "x", "y", "z", "h", None, "f") for i, t in TEXTS * repeat]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = np.array([xxhash.xxh64_intdigest(g.encode(), 42) for g in grams], dtype=np.uint64)
    counts = [int((hashes >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)]
    return sum(1 << b for b, c in enumerate(counts) if 2 * c > len(grams))


def linked(n, pairs):
    """Component number of each of n members."""
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def simhash_classes(texts, radius=4):
    values = [simhash(t) for t in texts]
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= radius]
    return values, linked(len(values), pairs)


def smallest(ids):
    return min((i for i in ids if i is not None), default=None)


def grouped(keys, values):
    out = defaultdict(list)
    for k, v in zip(keys, values, strict=True):
        out[k].append(v)
    return out


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(lower(text))


def hits(text, items, window=10):
    """(flags of words, item ids) for a text and (id, text) items."""
    own, found = words(text), set()
    flags = [False] * len(own)
    for item, item_text in items:
        parts = words(item_text)
        for s in range(max(1, len(parts) - window + 1) if parts else 0):
            w = parts[s : s + window]
            for i in range(len(own) - len(w) + 1):
                if own[i : i + len(w)] == w:
                    flags[i : i + len(w)] = [True] * len(w)
                    if item is not None:
                        found.add(str(item))
    return flags, found
