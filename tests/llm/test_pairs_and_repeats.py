"""Jaccard join, components and repeated substrings against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fiscora.llm import jaccard, substring
from fiscora.llm.common import mix, shingle_sets, text_chunks, window_hashes, word_hashes
from fiscora.llm.components import components

from .corpus import WORD, documents, frame, linked, shingles, without_repeats


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab é\t\n\x0b\x1c x", max_size=30)), min_size=1, max_size=8), st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, chunk):
    seen: dict[str, int] = {}
    for a, b, buf, offs in text_chunks(pa.array(texts, pa.string()), chunk):
        h, first, _ = word_hashes(buf, offs)
        for r in range(a, b):
            found = WORD.findall(texts[r] or "")
            mine = h[first[r - a] : first[r - a + 1]].tolist()
            assert len(found) == len(mine)
            for w, x in zip(found, mine):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_long_words_and_windows():
    texts = ["x" * 5000 + " a", "x" * 5001 + " a", "y" * 1024, "x" * 5000]
    hashes = {}
    for a, _, buf, offs in text_chunks(pa.array(texts), 6000):
        h, first, _ = word_hashes(buf, offs)
        for r in range(len(offs) - 1):
            hashes[a + r] = h[first[r] : first[r + 1]].tolist()
    assert hashes[0][0] == hashes[3][0] != hashes[1][0] and hashes[0][1] == hashes[1][1]
    w = mix(np.arange(50, dtype=np.uint64))
    both = window_hashes(np.concatenate([w, w]), 7, np.uint64(0x9E3779B97F4A7C15))
    assert (both[:44] == both[50:94]).all() and len(set(both[:50].tolist())) == 50


def test_shingles_lower_only_ascii():
    sets = dict(shingle_sets(pa.array(["A b C d", "a B c D", "É b c d", "é b c d", "a", "A", None, " "]), 4))
    assert (sets[0] == sets[1]).all() and (sets[2] != sets[3]).all() and sets[4] == sets[5] and not len(sets[6]) and not len(sets[7])


def same(got, expected):
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted(got, key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("k, percent, options", [(4, 85, {}), (5, 80, {}), (4, 85, {"hot": 2, "block": 3, "broadcast_rows": 0}), (4, 85, {"block_tokens": 300}), (2, 50, {"hot": 1, "max_hot": 5, "block": 2, "pairs_up_to": 1}), (4, 85, {"block": 2, "pairs_up_to": 2}), (5, 80, {"block": 3, "pairs_up_to": 1, "broadcast_rows": 0})])
def test_linked_equals_brute_force(spark, k, percent, options):
    rows = documents()
    got = jaccard.linked(frame(spark, rows), k=k, percent=percent, **options).collect()
    assert got[0].__fields__ == ["doc_id", "n_shingles", "component_id"]
    same(map(tuple, got), linked(rows, k, percent))


def test_linked_chain_hub_and_null_ids(spark):
    rnd = random.Random(5)
    w = [f"a{i}" for i in range(100)]
    rows = []
    for i in range(40):  # neighbours link, ends do not
        rows.append((100 - i, " ".join(w)))
        w[rnd.randrange(100)] = f"b{i}"
    rows += [(None, rows[0][1]), (None, None)]
    same(map(tuple, jaccard.linked(frame(spark, rows)).collect()), linked(rows, 4, 85))


def test_a_wide_family_of_chains_and_strays(spark):
    """Chains, copies and strays that the bitmaps cannot tell apart, in many blocks of one family."""
    rnd = random.Random(11)
    base = [f"a{i}" for i in range(120)]
    rows, n = [], 0
    for chain in range(3):
        w = list(base)
        for i in rnd.sample(range(120), 25):
            w[i] = f"c{chain}x{i}"
        for _ in range(25):
            rows.append((n, " ".join(w)))
            w[rnd.randrange(120)] = f"b{n}"
            n += 1
    for _ in range(15):
        w = list(base)
        for i in rnd.sample(range(120), rnd.choice((1, 3, 9, 20))):
            w[i] = f"s{n}x{i}"
        rows.append((n, " ".join(w)))
        n += 1
    rnd.shuffle(rows)
    want = linked(rows, 4, 85)
    for block, pairs_up_to in ((7, 1), (20, 2)):
        same(map(tuple, jaccard.linked(frame(spark, rows), block=block, pairs_up_to=pairs_up_to).collect()), want)


def test_linked_empty_table(spark):
    assert jaccard.linked(frame(spark, [(1, "a")]).filter("false")).collect() == []
    assert [tuple(r) for r in jaccard.linked(frame(spark, [(1, None)])).collect()] == [(1, 0, 1)]


def test_bitmaps_never_lose_a_link():
    rnd = np.random.default_rng(2)
    for n in (3, 40, 300, 5000):
        a = np.unique(mix(rnd.integers(0, 1 << 60, n).astype(np.uint64)))
        for gone in range(0, max(1, n // 12), max(1, n // 40)):
            b = np.unique(np.concatenate([a[gone:], mix(rnd.integers(0, 1 << 60, gone // 2).astype(np.uint64))]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                maps = jaccard.Bitmaps(pa.array([jaccard.bitmap(x, jaccard.bitmap_words(len(x))).tobytes() for x in (a, b)], pa.binary()))
                assert maps.apart(np.array([0]), np.array([1]))[0] <= jaccard.differences(len(a), len(b), 85)
                p = [set(x[: jaccard.prefix_size(len(x), 85)].tolist()) for x in (a, b)]
                assert p[0] & p[1]


def test_open_groups_equals_all_pairs():
    rnd = random.Random(3)
    texts = [t for _, t in documents(4) if t and len(shingles(t, 4)) > 3] + [" ".join(f"w{rnd.randrange(30)}" for _ in range(40)) for _ in range(50)]
    sets = {i: s for i, s in shingle_sets(pa.array(texts), 4)}
    trees, brute = jaccard.Sets(len(texts)), jaccard.Sets(len(texts))
    for a, b in jaccard.open_groups(np.arange(len(texts)), [sets[i] for i in range(len(texts))], 85):
        trees.join(a, b)
    for a in range(len(texts)):
        for b in range(a):
            both = len(shingles(texts[a], 4) & shingles(texts[b], 4))
            if 100 * both >= 85 * (len(shingles(texts[a], 4)) + len(shingles(texts[b], 4)) - both):
                brute.join(a, b)
    assert [trees.find(i) for i in range(len(texts))] == [brute.find(i) for i in range(len(texts))]


def test_groups_bound_every_link():
    """Groups of similar sets: their bounds never shut out a link, and the matrix of unions shuts out most strangers."""
    rnd = random.Random(7)
    texts = []
    for _ in range(30):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randint(40, 400))]
        for _ in range(rnd.randint(1, 30)):
            w = list(base)
            for _ in range(rnd.randrange(4)):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(9999)}"
            texts.append(" ".join(w))
    sets = [s for _, s in sorted(shingle_sets(pa.array(sorted(set(texts))), 4))]
    sets.sort(key=lambda s: (int(s[0]), len(s)))
    sizes, least = np.array([len(s) for s in sets]), np.array([int(s[0]) for s in sets], np.uint64)
    column = pa.array([jaccard.bitmap(s, jaccard.bitmap_words(len(s))).tobytes() for s in sets], pa.binary())
    maps = jaccard.Bitmaps(column)
    runs = jaccard.form_groups(np.arange(len(sets)), sizes, least, maps, 85)
    assert [r[0] for r in runs] == [0, *(r[1] for r in runs[:-1])] and runs[-1][1] == len(sets) and max(b - a for a, b in runs) > 3 and all(b - a <= jaccard.GROUP for a, b in runs)
    rows = [maps.flat[maps.at[a:b][:, None] + np.arange(maps.width[a])] for a, b in runs]
    groups = jaccard.GroupMaps(pa.array([np.bitwise_or.reduce(r).tobytes() for r in rows], pa.binary()), pa.array([None if len(r) == 1 else np.bitwise_and.reduce(r).tobytes() for r in rows], pa.binary()))
    low, high = (np.array([f(sizes[a:b]) for a, b in runs]) for f in (min, max))
    of = np.repeat(np.arange(len(runs)), [b - a for a, b in runs])
    i, j = np.triu_indices(len(runs), 1)
    bound = dict(zip(zip(i.tolist(), j.tolist()), (groups.apart(i, j) <= jaccard.differences(high[i], high[j], 85)).tolist()))
    for x in range(len(sets)):
        for y in range(x):
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if of[x] != of[y]:
                if 100 * both >= 85 * (sizes[x] + sizes[y] - both):
                    assert bound[int(of[y]), int(of[x])]
    shut = sum(not ok for ok in bound.values())
    assert shut > 0.7 * len(bound)


def test_repeated_rows_are_sent_once():
    batch = pa.RecordBatch.from_arrays([pa.array([1] * 6), pa.array([5, 5, 5, 6, 6, 5]), pa.array(["a", "a", "b", "a", None, "a"])], names=["root", "node", "_text"])
    assert sum(b.num_rows for b in jaccard._once(iter([batch, batch]))) == 4


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 7), (20, 20), (30, 31), (31, 30), (30, 31)] + [(100, 100 + i) for i in range(1, 50)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{i: 1 for i in range(1, 6)}, 7: 7, 8: 7, 9: 7, 30: 30, 31: 30, **{100 + i: 100 for i in range(50)}}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
    with pytest.raises(RuntimeError):
        components(spark.createDataFrame([(i, i + 1) for i in range(64)], "u long, v long"), rounds=1)


@pytest.mark.parametrize("length, options", [(35, {}), (21, {}), (35, {"broadcast_bytes": 0, "bucket_bytes": 1000})])
def test_repeats_equal_brute_force(spark, length, options):
    rows = documents(7)
    got = substring.remove_repeats(frame(spark, rows), length, with_text=True, **options).collect()
    expected = [(i, n, gone, hashlib.sha256(" ".join(kept).encode()).hexdigest(), " ".join(kept)) for i, n, gone, kept in without_repeats(rows, length)]
    same([tuple(r) for r in got], expected)
    assert any(0 < e[2] < e[1] for e in expected)


def test_repeats_limits(spark):
    assert substring.remove_repeats(frame(spark, [(1, "a")]).filter("false")).collect() == []
    with pytest.raises(ValueError):
        substring.remove_repeats(frame(spark, [(1, "a")]), 20).collect()


def test_cover_has_every_difference():
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40), st.integers(0, 6)), max_size=30))
def test_intervals(found):
    doc, lo, length = (np.array(x, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    d, a, b = substring.merge_intervals(doc, lo, lo + length)
    points = lambda d, a, b: {(int(x), p) for x, y, z in zip(d, a, b) for p in range(y, z + 1)}
    assert points(d, a, b) == points(doc, lo, lo + length)
    assert all(d[i] < d[i + 1] or b[i] + 1 < a[i + 1] for i in range(len(d) - 1))
    again = substring.unpack_intervals(substring.pack_intervals(d, a, b))
    assert all((x == y).all() for x, y in zip(again, (d, a, b)))


def test_columns_of_the_same_groups_are_one():
    pairs = [(t, g) for t in range(40) for g in (7, 9)] + [(50, 7)] + [(60, g) for g in range(70)] + [(61, g) for g in range(70)] + [(70, 7), (70, 9), (70, 11)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs[a : a + 33])], names=["t", "g"]) for a in range(0, len(pairs), 33)]
    found: dict[int, set] = {}
    for b in jaccard.merged_columns(iter(batches)):
        for t, g, c in zip(*(x.to_pylist() for x in b.columns)):
            found.setdefault(t, set()).add((g, c))
    assert sorted(map(sorted, found.values())) == sorted([[(7, 2), (9, 2)], [(7, 3), (9, 3), (11, 3)], *[[(g, 70) for g in range(70)]] * 2])
    assert {60, 61} <= set(found)


def test_frequent_tokens_are_counted_over_all_rows():
    texts = [f"a b c d {i} e f g {i % 3} h" for i in range(90)]
    batch = lambda some: pa.RecordBatch.from_arrays([pa.array(some)], names=["_text"])
    sent = list(jaccard._dealt_bits(2, 80, 5)(iter([batch(texts[:40]), batch(texts[40:])])))
    found: dict[int, int] = {}
    for part in range(5):
        for b in jaccard._counter(20)(iter([x.slice(part, 1) for x in sent])):
            found |= dict(zip(*(x.to_pylist() for x in b.columns)))
    counts: dict[int, int] = {}
    for _, s in shingle_sets(pa.array(texts), 2):
        for token in jaccard.low_bits(s[: jaccard.prefix_size(len(s), 80)]).tolist():
            counts[token] = counts.get(token, 0) + 1
    assert found == {t: c for t, c in counts.items() if c > 20} and found


def test_texts_of_a_family_of_thousands_are_sent_once(spark, monkeypatch):
    written, write = {}, jaccard.materialise
    monkeypatch.setattr(jaccard, "materialise", lambda df, name: written.setdefault(name, write(df, name)))
    words = " ".join(f"w{i}" for i in range(60))
    got = jaccard.linked(frame(spark, [(i, f"{words} t{i}") for i in range(2100)])).collect()
    assert {r["component_id"] for r in got} == {0}
    assert written["family-sizes"].agg({"blocks": "max"}).first()[0] == 1
    assert "low" not in written["sets"].columns
