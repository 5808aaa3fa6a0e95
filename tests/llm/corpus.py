"""Small made corpora and brute-force versions for the operators' tests."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Extra columns whose names clash with what operators make inside.
EXTRA = "score double, lang_pred string, component_id long, size long, `_id` string, `_key` string, n_words long, text2 string"
EXTRA_VALUES = (0.5, "xx", -1, -1, "i", "k", -1, "t")
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def words(rnd: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def documents(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """(doc_id, text): exact and near copies, shared passages, long and empty texts, odd white space, repeated ids."""
    rnd = random.Random(seed)
    passage = words(rnd, 60)
    out: list[tuple[int | None, str | None]] = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "one two three"), (6, "Überlänge Straße"), (7, "x x\x0cy\x0bz\r\nq"), (8, "the " * 300), (9, "THE " * 300)]
    base = [words(rnd, rnd.randint(30, 200)) for _ in range(12)]
    n = 10
    for b in base:
        for copy in range(rnd.randint(1, 8)):
            w = list(b)
            for _ in range(copy // 2):
                w[rnd.randrange(len(w))] = f"edit{rnd.randrange(9999)}"
            out.append((n, " ".join(w)))
            n += 1
    for _ in range(12):
        w = words(rnd, 50)
        at = rnd.randrange(50)
        out.append((n, " ".join(w[:at] + passage[rnd.randrange(10) :] + w[at:])))
        n += 1
    out.append((n, "\n".join(words(rnd, 3000))))
    out.append(out[15])  # a row twice
    out.append((out[16][0], "another text of an id that is there"))
    return out


def frame(spark, rows, lang="en", source="s"):
    made = [(i, t, lang, source, None if t is None else len(t), *EXTRA_VALUES) for i, t in rows]
    return spark.createDataFrame(made, SCHEMA)


def shingles(text: str | None, k: int) -> frozenset:
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def linked(rows, k: int, percent: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id) by comparing all pairs of sets; equal sets are one node."""
    sets: dict[frozenset, int] = {}
    for i, t in rows:
        s = shingles(t, k)
        if s and i is not None:
            sets[s] = min(i, sets.get(s, i))
    nodes = list(sets)
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(nodes)):
        for b in range(a):
            both = len(nodes[a] & nodes[b])
            if 100 * both >= percent * (len(nodes[a]) + len(nodes[b]) - both):
                root[find(a)] = find(b)
    least: dict[int, int] = {}
    for a, s in enumerate(nodes):
        r = find(a)
        least[r] = min(least.get(r, sets[s]), sets[s])
    of = {s: least[find(a)] for a, s in enumerate(nodes)}
    return [(i, len(shingles(t, k)), None if i is None else of.get(shingles(t, k), i)) for i, t in rows]


def without_repeats(rows, length: int) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept words)."""
    from collections import Counter

    split = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for (i, _), w in zip(rows, split):
        gone = [False] * len(w)
        for at in range(len(w) - length + 1):
            if seen[tuple(w[at : at + length])] > 1:
                gone[at : at + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), kept))
    return out
