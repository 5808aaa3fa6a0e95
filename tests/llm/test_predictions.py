"""The predicting queries against plain versions of what they state."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fiscora.llm import langid, queries, toxicity
from fiscora.llm.common import letter_words

from .corpus import EXTRA, EXTRA_VALUES, frame


def made(n=120):
    rnd = random.Random(4)
    sets = {"aa": "aeimnrst", "bb": "uoklpvwz"}
    text = lambda lang: " ".join("".join(rnd.choice(sets[lang]) for _ in range(rnd.randint(2, 7))) for _ in range(rnd.randint(1, 30)))
    rows = []
    for i in range(n):
        lang = rnd.choice(("aa", "bb"))
        rows.append((i, text(lang) + (" " + text("bb") if i % 9 == 0 else ""), lang if i % 11 else None))
    return rows + [(500, None, "aa"), (501, "", None), (502, "12 34", "bb"), (None, text("aa"), "aa"), (7, rows[7][1], rows[7][2]), (7, text("bb"), "bb")]


def plain_marginals(chain, text):
    """The mean label probabilities of a text's words, by forward-backward in plain Python."""
    code, starts, ends, _ = letter_words([text])
    if not len(starts):
        return None
    emit, step = np.asarray(chain.emissions(code, starts, ends), float), np.exp(np.asarray(chain.trans, float))
    n, k = emit.shape
    ahead, back = [emit[0] / emit[0].sum()], [np.ones(k)]
    for t in range(1, n):
        x = [sum(ahead[-1][a] * step[a, b] for a in range(k)) * emit[t, b] for b in range(k)]
        ahead.append(np.array(x) / sum(x))
    for t in range(n - 1, 0, -1):
        x = [sum(step[a, b] * emit[t, b] * back[-1][b] for b in range(k)) for a in range(k)]
        back.append(np.array(x) / sum(x))
    total = np.zeros(k)
    for f, b in zip(ahead, back[::-1]):
        p = f * b
        total += p / p.sum()
    return total / n


def test_language_query_equals_a_plain_version(spark, tmp_path):
    rows = made()
    df = spark.createDataFrame([(i, t, y, "s", 0, *EXTRA_VALUES) for i, t, y in rows], f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op2_language(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["doc_id", "held_out", "lang_pred", "score"]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    assert all(r["held_out"] == held(r["doc_id"]) for r in got) and any(r["held_out"] for r in got)
    known = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2, F.lit(False))
    chain = langid.train(langid.training_rows(docs, known, 400, "text", "lang", "doc_id"))
    want = []
    for i, t, _ in rows:
        mean = plain_marginals(chain, t)
        want.append((i, "und", 0.0) if mean is None else (i, chain.labels[int(mean.argmax())], float(mean.max())))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    for a, b in zip(sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in got), key=key), sorted(want, key=key)):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-3)


def test_toxicity_equals_a_plain_version(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    rows = []
    for i in range(300):
        w = [word() for _ in range(rnd.randint(10, 60))]
        for _ in range(rnd.randint(2, 9) if i % 4 == 0 else 0):
            w[rnd.randrange(len(w))] = rnd.choice(("vilezz", "nastyzz"))
        rows.append((i, " ".join(w)))
    rows += [(900, None), (901, ""), rows[0], rows[0], (902, "vilezz " * 5000)]
    docs, labels = frame(spark, rows), spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    got = sorted(((r["doc_id"], r["expected_severity"], r["grade"], r["toxic"]) for r in toxicity.score(docs, labels).collect()))
    model = toxicity.train(docs, labels, 5000, 3, "doc_id", "text", "toxic")
    weights, want = model.weights.astype(np.float32), []
    for i, t in rows:
        _, row, value = toxicity.features([t])
        s = sum(float(weights[r]) * v for r, v in zip(row.tolist(), value.tolist()))
        above = [1 / (1 + np.exp(-(s - c))) for c in model.cuts]
        want.append((i, sum(above), sum(a >= 0.5 for a in above), bool(above[0] >= 0.5)))
    assert len(got) == len(rows) and sorted(model.cuts) == list(model.cuts)
    for a, b in zip(got, sorted(want)):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-4) and a[2:] == b[2:]
    assert len({g[1:] for g in got if g[0] == 0}) == 1


def test_pipeline_keeps_a_corpus_without_labels(spark, tmp_path):
    import corpus_pipeline

    rows = [(1, "one two"), (2, "12 !"), (3, None), (4, "\u00e9")]
    kept = corpus_pipeline.language_stage(spark, frame(spark, rows, lang=None), str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4]
