"""Archives, top-k search, mixing, decontamination and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import io
import random
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from fiscora.llm import decontam, mixing, topk, warc

from .corpus import EXTRA, EXTRA_VALUES, WORD, documents, frame, linked, words

# ---- archives ----------------------------------------------------------------------------------------------------


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("options", [{}, {"min_bytes": 4, "broadcast_rows": 0}])
def test_round_trip(spark, options):
    rows = [(1, "http://x/1", "<p>é</p>"), (2, "http://x/ü b\r\n", "<p>é</p>"), (3, None, "<p>é</p>"), (4, "u", None), (5, "u", ""), (6, "u", "x" * 300_000), (7, "u", "abc"), (8, "u", "abc"), (8, "u", "abc")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, payload_bytes long, `_id` string")
    got = warc.round_trip(df, **options).collect()
    assert len(got) == len(rows)
    least = options.get("min_bytes", 0)
    newest = {}
    for i, _, h in rows:
        newest[h or ""] = max(i, newest.get(h or "", i))
    want = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        to = newest[h or ""] if newest[h or ""] != i and len(data) >= least else None
        want[i, len(data), sha1(data), "revisit" if to else "response", to] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    assert all(r["payload"].decode() == {i: h or "" for i, _, h in rows}[r["page_id"]] for r in got if r["record_type"] == "response")
    assert warc.round_trip(df.filter("false")).collect() == []


def test_qualified_paths(spark, tmp_path):
    assert warc.qualified(spark, str(tmp_path)) == f"file://{tmp_path}" == warc.qualified(spark, f"file://{tmp_path}")


def archive(records: list[bytes], dictionary: bytes, packed=True) -> bytes:
    inner = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
    engine = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    return warc.SKIPPABLE + len(inner).to_bytes(4, "little") + inner + b"".join(map(engine.compress, records))


RECORD = warc.build_record("7", "http://x/", b"payload", None, "2024-01-01T00:00:00Z")


def test_reader_validates():
    dictionary = warc.train_dictionary([b"<p>hello</p>"])
    big = warc.build_record("8", None, bytes(range(256)) * 20000, None, "2024-01-01T00:00:00Z")
    data = archive([RECORD, big], dictionary)
    assert list(warc.read_frames(io.BytesIO(data))) == [RECORD, big] == list(warc.read_frames(io.BytesIO(archive([RECORD, big], dictionary, packed=False))))
    assert list(warc.read_frames(io.BytesIO(b""))) == []
    assert warc.parse_record(RECORD)["payload"] == b"payload"
    for broken in (data[:20], data[:-5], data + b"junkjunk"):
        with pytest.raises(warc.WarcError):
            list(warc.read_frames(io.BytesIO(broken)))
    revisit = warc.build_record("7", "u", b"payload", "9", "2024-01-01T00:00:00Z")
    assert warc.parse_record(revisit)["payload_bytes"] == 7 and warc.parse_record(revisit)["headers"]["warc-refers-to"] == "<urn:page:9>"
    for old, new in ((b"WARC/1.1", b"WARK/1.1"), (b"payload\r\n", b"payloae\r\n"), (b"WARC-Date: 2024-01-01T00:00:00Z\r\n", b""), (b"payload\r\n", b"payloadd\r\n"), (b"WARC-Type: ", b"WARC-Type ")):
        with pytest.raises(warc.WarcError):
            warc.parse_record(RECORD.replace(old, new))
    with pytest.raises(warc.WarcError):
        warc.parse_record(revisit.replace(b"WARC-Refers-To", b"X-Refers-To"))


# ---- top-k -------------------------------------------------------------------------------------------------------


def brute_top(rows, k=5, every=50):
    ints = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for at, (i, q) in enumerate(ints):
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for n, (j, v) in enumerate(ints) if n != at and len(v) == len(q))[:k]
            out.update((i, r, j, -s) for r, (s, j) in enumerate(found, 1))
    return out


@pytest.mark.parametrize("options", [{}, {"part_bytes": 6000, "part_rows": 7}])
def test_top_k(spark, options):
    rnd = np.random.default_rng(1)
    rows = [(i, rnd.normal(0, 0.1, 40).astype(np.float32).tolist()) for i in range(400)]
    rows[101] = (101, rows[100][1])
    rows[102] = (102, rows[100][1])
    rows += [(500, None), (501, [None] * 40), (550, [float("nan")] * 40), (600, [float("inf")] * 40), (650, []), (700, [1.0, 2.0]), (701, [3.0, 4.0]), (None, rows[0][1]), (750, [0.0] * 40), (800, [1.0])]
    rows += [(0, rows[7][1]), (0, rows[8][1]), (50, rows[50][1]), (9, rows[9][1]), (900, rnd.normal(0, 1, 30_000).tolist()), (901, rnd.normal(0, 1, 30_000).tolist()), (950, [1e-3] * 30_000)]
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id long, embedding array<float>, score long, rank int, `_v` string")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, **options)
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert Counter(map(tuple, got.collect())) == brute_top(rows)
    assert topk.top_k(df.filter("false"), F.lit(True)).collect() == []


def test_top_k_of_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [2.0, 0.0]), (3, [0.0, 2.0]), (4, [3.0, 3.0])]
    got = Counter(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()))
    assert got == brute_top(rows) and sum(got.values()) == 10 and sorted(r for _, r, _, _ in got.elements()) == sorted([1, 2, 3, 4, 5] * 2)


def test_top_k_large_values_stay_exact(spark):
    rows = [(i * 50, [float(300_000 * (i + 1) + i), 1e6]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0).collect())) == brute_top(rows)


def test_large_values_are_bounded_too():
    """One large component does not make all pairs be scored by integers: what the bounds rule out is never opened."""
    rnd = np.random.default_rng(3)
    vectors = rnd.integers(-(1 << 24), 1 << 24, (3000, 48))
    vectors[5] = 1 << 32
    block, opened = topk.Part(np.arange(3000), np.arange(3000), vectors), []

    class Counting(np.ndarray):
        def __getitem__(self, at):
            opened.append(np.size(at))
            return np.asarray(super().__getitem__(at))

    block.vectors = vectors.view(Counting)
    queries = vectors[:20]
    got = Counter(topk.best_of(np.arange(20), queries, [block], 5))
    want = Counter()
    for i in range(20):
        scores = sorted((-int(np.dot(queries[i].astype(object), v.astype(object))), n) for n, v in enumerate(vectors) if n != i)[:5]
        want.update((i, n, -s) for s, n in scores)
    assert got == want and sum(opened) < 20 * 20


def test_scores_beyond_a_long_are_ties():
    vectors = np.array([[1 << 40, 1 << 40], [1 << 41, 0], [1 << 42, 1 << 42], [1, 2], [-(1 << 62), -(1 << 62)]])
    got = [(j, s) for _, j, s in topk.best_of(np.array([2]), vectors[2:3], [topk.Part(np.arange(5), np.array([9, 8, 7, 6, 5]), vectors)], 4)]
    assert got == [(8, (1 << 63) - 1), (9, (1 << 63) - 1), (6, 3 << 42), (5, -(1 << 63))]




# ---- mixing ------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights, share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > most * sizes[s]]
        if not over:
            target |= {s: left * w[s] / total for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def mixed_rows(seed):
    rnd = random.Random(seed)
    rows = [(i, " ".join(words(rnd, rnd.randint(0, 60))), None, rnd.choices(["a", "B", "é", "b", None, "zz", "empty"], [50, 3, 3, 20, 5, 1, 1])[0], 0, *EXTRA_VALUES) for i in range(600)]
    return [(i, None if s == "empty" else t, y, s, *rest) for i, t, y, s, *rest in rows]


@pytest.mark.parametrize("range_rows, weights", [(4096, [5, 2, 1]), (7, [5, 2, 1]), (50, [1, 9])])
def test_mix(spark, range_rows, weights):
    rows = mixed_rows(range_rows)
    df = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")
    got = mixing.mix_sources(df, weights, range_rows=range_rows).collect()
    assert got[0].__fields__ == ["doc_id", "size", "source_size", "target", "taken"] and len(got) == len(rows)
    sizes: Counter = Counter()
    of = {}
    for i, t, _, s, *_ in rows:
        n = len(WORD.findall(t or ""))
        sizes[s] += n
        of[i] = (s, n)
    target, taken = brute_targets(sizes, weights), Counter()
    for r in got:
        s, n = of[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, sizes[s]) and r["target"] == pytest.approx(target[s]) and 0 <= r["taken"] <= 2 * n
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    again = mixing.mix_sources(df.repartition(3), weights, range_rows=range_rows).collect()
    assert {r["doc_id"]: r["taken"] for r in got} == {r["doc_id"]: r["taken"] for r in again}


def test_mix_reruns_agree(spark):
    """Null ids, repeated ids with equal and other texts, one id on a third of the rows, and a very long text."""
    rnd = random.Random(6)
    rows = [(None, " ".join(words(rnd, rnd.randint(0, 9))), "a") for _ in range(300)] + [(7, " ".join(words(rnd, rnd.randint(0, 9))), "a") for _ in range(200)]
    rows += [(8, "one two three", "b")] * 250 + [(9, "w " * 200_000, "c"), (None, None, None), (None, None, "a")]
    results = []
    for parts in (1, 3, 7):
        rnd.shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        results.append(Counter(map(tuple, mixing.mix_sources(df, [5, 2, 1], range_rows=40).collect())))
    assert results[0] == results[1] == results[2] and sum(results[0].values()) == len(rows)
    taken: Counter = Counter()
    sizes = {s: sum(len(WORD.findall(t or "")) for _, t, x in rows if x == s) for s in ("a", "b", "c", None)}
    target = brute_targets(sizes, [5, 2, 1])
    for (_, size, source_size, goal, n), times in results[0].items():
        taken[goal] += n * times
        assert n <= 2 * size
    assert all(abs(taken[g] - sum(t for t in target.values() if t == pytest.approx(g))) <= 0.5 for g in taken)


def test_mix_spreads_a_hot_row(spark):
    df = spark.createDataFrame([(1, "a b", "s")] * 1000 + [(i, "c d e", "s") for i in range(50)], "doc_id long, text string, source string")
    assert sum(r["taken"] for r in mixing.mix_sources(df, [1], range_rows=100).collect()) == round(1.5 * 2150)


def test_mix_edges(spark):
    assert mixing.mix_sources(frame(spark, [(1, "a")]).filter("false"), [1]).collect() == []
    assert [tuple(r) for r in mixing.mix_sources(frame(spark, [(1, None)]), [5, 2, 1]).collect()] == [(1, 0, 0, 0.0, 0)]
    twice = mixing.mix_sources(frame(spark, [(1, "a b"), (1, "a b"), (2, "c")]), [1]).collect()
    assert len(twice) == 3 and sum(r["taken"] for r in twice) in (7, 8)


def test_mix_runs_no_python(spark):
    plan = mixing.mix_sources(frame(spark, [(1, "a b"), (2, "c")]), [1])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- decontamination ---------------------------------------------------------------------------------------------


def leak_corpus():
    rnd = random.Random(8)
    items = [(i, " ".join(words(rnd, rnd.randint(12, 50)))) for i in range(12)]
    items += [(20, "A train leaves Paris at 10 and travels 120 km before it meets Anna near the old bridge"), (21, ""), (22, None), (23, "too short"), (None, items[0][1]), items[1], (24, "1 2 3 4 5 6 7 8 9")]
    docs = [(i, " ".join(words(rnd, 80))) for i in range(40)]
    docs += [(100 + i, " ".join(words(rnd, 30)) + " " + t + " " + " ".join(words(rnd, 30))) for i, (_, t) in enumerate(items[:12])]
    docs += [(200, items[3][1].upper().replace(" ", "!! ")), (201, " ".join(items[4][1].split()[: len(items[4][1].split()) // 2]))]
    return items, docs


def test_leaks(spark):
    items, docs = leak_corpus()
    more = [(300, "Remember: A train leaves London at 9 and travels 75 km before it meets Carla near the old bridge today"), (301, "A train leaves Rome at 7 and travels 8 km before it meets"), (302, "5 6 7 8 9 10 11 12 13 14 15 16"), (303, None), (304, ""), (None, items[0][1]), (305, "too short")]
    bench = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, coverage long, `_doc` string")
    got = decontam.leaks(frame(spark, docs + more + [docs[45]]), bench, **{}).collect()
    pairs = [(r["doc_id"], r["item_id"]) for r in got]
    assert sorted(pairs) == sorted([(100 + i, i) for i in range(12)] + [(200, 3), (300, 20), (305, 23)])
    assert all(0.8 <= r["coverage"] <= 1 and r["matched"] <= r["windows"] for r in got)
    shuffled = decontam.leaks(frame(spark, docs + more), bench, broadcast_rows=0).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in shuffled) == sorted(pairs)


def test_slots_must_be_consistent(spark):
    item = "The box of Anna holds 5 red balls and then Anna adds 5 blue balls to the box"
    same = item.replace("5", "8").replace("Anna", "Bert")
    mixed = "The box of Bert holds 1 red balls and then Carl adds 9 blue balls to the box"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontam.leaks(frame(spark, [(1, "So. " + same), (2, "So. " + mixed), (3, item)]), bench).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 3]


def test_plain_copies_of_any_case_and_spacing(spark):
    item = "A train leaves Paris at 10 and travels 120 km before it meets Anna near the old bridge"
    bench = spark.createDataFrame([(1, item), (2, item.lower().replace("train", "tram"))], "item_id long, text string")
    docs = [item.lower(), item.upper(), item.replace(" ", "  "), item.replace(" ", "\r\n"), item.replace("train", "tram"), item.lower().replace("paris", "rome").replace("10", "x")]
    got = decontam.leaks(frame(spark, [(i, f"so. {t} the end") for i, t in enumerate(docs)]), bench).collect()
    assert {(0, 1), (1, 1), (2, 1), (3, 1), (4, 2)} <= {(r["doc_id"], r["item_id"]) for r in got} and 5 not in {r["doc_id"] for r in got}
    assert all(r["coverage"] == 1 for r in got if (r["doc_id"] < 4 and r["item_id"] == 1))
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got})


def test_templates(spark):
    df = spark.createDataFrame([("He ran 5 km, 3.5kg and 1,000 to Paris. Then",), (None,), ("  \t",), ("ALL CAPS 7",)], "t string")
    rows = df.select(decontam.template_words(df.t).alias("a"), decontam.value_words(df.t).alias("b")).collect()
    n, u, p = decontam.NUMBER, decontam.UNIT, decontam.NAME
    assert rows[0]["a"] == ["he", "ran", n, u, n + u, "and", n, "to", p, "then"] and rows[0]["b"] == ["he", "ran", "5", "km", "35kg", "and", "1000", "to", "paris", "then"]
    assert rows[1]["a"] == rows[2]["a"] == [] and rows[3]["a"] == ["all", "caps", n]


def test_leaks_of_empty_tables(spark):
    items, docs = leak_corpus()
    bench = spark.createDataFrame([(i, t) for i, t in items], "item_id long, text string")
    assert decontam.leaks(frame(spark, docs).filter("false"), bench).collect() == []
    assert decontam.leaks(frame(spark, docs), bench.filter("false")).collect() == []


# ---- pipeline ----------------------------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp

    items, docs = leak_corpus()
    near = documents(9)
    plain = [(1000 + i, t) for i, t in docs] + [(2000 + (i or 0), t) for i, t in near if t is not None and i not in (1, 2)]
    bad = [(9000, None), (9001, ""), (9002, "123 456 !!!")]
    secret = (9100, "please use token = abcdef123456 in the first of all these lines")
    table = frame(spark, [*plain, *bad, secret])
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, t) for i, t in items], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in cp.STAGES] == ["language identification", "near duplicates", "benchmark decontamination", "secret scan", "mixing"]
    first = cp.language_stage(spark, table, str(tmp_path))
    kept = {r["doc_id"] for r in first.select("doc_id").collect()}
    assert kept == {i for i, t in [*plain, secret] if any(c.isalpha() for c in t)} and first.columns == table.columns
    second = cp.near_duplicate_stage(spark, first, str(tmp_path))
    rows = [(r["doc_id"], r["text"]) for r in first.select("doc_id", "text").collect()]
    assert sorted(r["doc_id"] for r in second.select("doc_id").collect()) == sorted({i for i, _, c in linked(rows, 5, 80) if i == c})
    third = cp.decontamination_stage(spark, second, str(tmp_path))
    gone = {r["doc_id"] for r in second.select("doc_id").collect()} - {r["doc_id"] for r in third.select("doc_id").collect()}
    assert {1100 + i for i in range(12)} <= gone <= {1100 + i for i in range(12)} | {1200}
    fourth = cp.secret_stage(spark, third, str(tmp_path))
    assert {r["doc_id"]: r["text"] for r in fourth.collect()}[9100] == "please use [SECRET] in the first of all these lines"
    assert fourth.count() == third.count() and fourth.columns == table.columns
    final = cp.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in final.collect()} == {r["doc_id"] for r in fourth.collect()}


def test_rows_of_one_id_are_judged_each(spark, tmp_path):
    import corpus_pipeline as cp

    rnd = random.Random(3)
    a, b, c, d, item = (" ".join(words(rnd, 60)) for _ in range(5))
    rows = [(3, a), (5, b), (5, a), (7, c), (7, c + " x"), (7, c), (8, d), (8, d), (9, c), (None, a), (None, a)]
    for seed in range(2):
        rnd.shuffle(rows)
        kept = cp.near_duplicate_stage(spark, frame(spark, rows), str(tmp_path)).select("doc_id", "text").collect()
        got = Counter(map(tuple, kept))
        of7 = [t for i, t in got if i == 7]
        assert len(of7) == 1 and of7[0] in (c, c + " x") and (not seed or of7 == first)
        first = of7
        assert got == Counter([(3, a), (5, b), (7, of7[0]), (8, d), (None, a), (None, a)])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    mixed = frame(spark, [(5, b), (5, "so " + item), (None, item), (None, a)])
    assert Counter(tuple(r)[:2] for r in cp.decontamination_stage(spark, mixed, str(tmp_path)).collect()) == Counter([(5, b), (None, a)])


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline as cp

    frame(spark, [(1, "x")]).filter("false").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
