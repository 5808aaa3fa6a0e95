"""Models are fitted to every row: no sample decides what they know."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from fiscora.llm import credential_scan, langid
from fiscora.llm.common import sample_share

from .corpus import frame

LETTERS = "QXZJVKWqxzjvkw"


def rare_rows(spark, n=4000):
    """Plain rows; those whose id a sample of 2,000 rows leaves out hold one of 40 odd words, which so are ordinary."""
    rnd = random.Random(5)
    odd = ["".join(rnd.choice(LETTERS) for _ in range(24)) for _ in range(40)]
    ids = frame(spark, [(i, "x") for i in range(n)])
    inside = {r["doc_id"] for r in sample_share(ids, "doc_id", 2000).collect()}
    rows = []
    for i in range(n):
        words = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 8))) for _ in range(6)]
        rows.append((i, " ".join(words + ([rnd.choice(odd)] if i not in inside else []))))
    assert 1000 < len(inside) < 3000
    return rows


def test_ordinary_tokens_of_every_row_are_known(spark):
    rows = rare_rows(spark)
    got = {r["doc_id"]: r["text"] for r in credential_scan.redact(frame(spark, rows)).collect()}
    assert got == dict(rows)


def test_learning_from_a_table_equals_learning_from_its_texts(spark):
    rnd = random.Random(6)
    both = "abcdefghijklmnopqrstuvwxyz0123456789"
    run = lambda n: "".join(rnd.choice(both) for _ in range(n))
    rows = [(i, t) for i, (_, t) in enumerate(rare_rows(spark, 2400)[:600])]
    rows += [(1000 + i, f"of us token = zq7-{run(20)} and the AKIA{run(20).upper()} so {'%032x' % rnd.getrandbits(128)}.") for i in range(500)]
    rows += [(3000, None), (3001, ""), (None, f"secret: {run(3000)} end"), (None, "x == y= secret===ab==cdefghijklmnop")]
    want = credential_scan.train([t for _, t in rows])
    rnd.shuffle(rows)
    for parts in (1, 7):
        got = credential_scan.learn(frame(spark, rows).repartition(parts), "text")
        assert got.evidence == want.evidence and got.ordinary.n3 == want.ordinary.n3
        assert [(a.steps, a.literals) for a in got.automata] == [(a.steps, a.literals) for a in want.automata]
    assert len(want.automata) == 10 and want.automata[7].literals[:4] == list("zq7-") and want.automata[8].literals == list("AKIA")


def test_trigrams_pairs_and_characters_are_counted_whole():
    tokens = ["ab", "a", "abc", "==", "ab", "x.y-z/"]
    k = len(credential_scan._SIGNS)
    found = credential_scan.counted_trigrams(Counter(tokens))
    grams = {credential_scan._SIGNS[g // k // k] + credential_scan._SIGNS[g // k % k] + credential_scan._SIGNS[g % k]: int(found[g]) for g in found.nonzero()[0]}
    padded = ["\x02\x02" + t for t in tokens]
    model = credential_scan.Ordinary([], grams)
    assert model.n3 == Counter(t[i : i + 3] for t in padded for i in range(len(t) - 2)) == credential_scan.Ordinary(tokens).n3
    assert model.n2 == Counter(t[i : i + 2] for t in padded for i in range(len(t) - 1))
    assert model.n1 == Counter("".join(padded)) and model.total == 1 + sum(map(len, padded))


def test_evidence_is_what_one_in_many_tokens_exceeds():
    ratios = {int(credential_scan.BINS * 4.5): 3, int(credential_scan.BINS * 5): 1}
    assert credential_scan.evidence_of(ratios, 50) == pytest.approx(credential_scan.SAFETY * 2.718281828**5, rel=1e-3)
    assert credential_scan.evidence_of(ratios, credential_scan.RARE) == pytest.approx(credential_scan.SAFETY * 2.718281828**4.5, rel=1e-3)
    assert credential_scan.evidence_of(ratios, 4 * credential_scan.RARE) == credential_scan.EVIDENCE == credential_scan.evidence_of({}, 0)


def labelled(n):
    """Rows of two languages with the same letters; each word tells its language, and most are in one row alone."""
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("aeionrst") for _ in range(7))
    return [(i, f"{word()} {word()} {word()}", ("aa", "bb")[i % 2]) for i in range(n)]


def test_words_of_every_labelled_row_are_known(spark):
    """What only one row of 3,000 teaches is known afterwards: its words tell the language of their own text."""
    rows = labelled(3000)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, F.lit(True)).collect()}
    assert sum(got[i] == y for i, _, y in rows) >= 0.97 * len(rows)


def test_language_model_of_a_table_equals_that_of_its_texts(spark, monkeypatch):
    monkeypatch.setattr(langid, "BUCKET", 700)
    rows = labelled(600) + [(700, None, "aa"), (701, "12", "cc"), (702, "été İx ΣΣ", "bb"), (None, "x" * 5000, "aa")]
    want = langid.train([(t, y) for _, t, y in rows if t is not None])
    random.Random(8).shuffle(rows)
    for parts in (1, 6):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts)
        got = langid.learn(docs, F.lit(True), 400, "text", "lang")
        assert got.labels == want.labels == ["aa", "bb"] and (got.weights == want.weights).all() and (got.trans == want.trans).all()
