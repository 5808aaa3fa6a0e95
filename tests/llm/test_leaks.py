"""Decontamination against a brute force of its stated rule, and its recall on re-parameterised copies."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
import regex

from fiscora.llm import common, decontam

from .corpus import frame

N, U, P, S = decontam.NUMBER, decontam.UNIT, decontam.NAME, decontam.START
K, SHARE = 5, 0.8
_INNER = regex.compile(r"(?<=[\p{L}\p{N},;:] )\p{Lu}\p{Ll}+(?![\p{L}\p{N}])")
_CAPITAL = regex.compile(r"(?<![\p{L}\p{N}])\p{Lu}\p{Ll}+(?![\p{L}\p{N}])")
_NUMBER = regex.compile(r"(?<![\p{L}\p{N}])\p{Nd}+(?:[.,:/-]\p{Nd}+)*(?=(?i:" + decontam.UNITS + r")?(?![\p{L}\p{N}]))")
_UNIT = regex.compile("(" + N + r"\p{Nd}+(?:[.,:/-]\p{Nd}+)* ?)((?i:" + decontam.UNITS + r"))(?![\p{L}\p{N}])")


def reading(text):
    """Words as (plain, template, template with sentence starts as words)."""
    t = regex.sub(f"[{N}-{S}]", "", regex.sub("[\t\n\x0b\x0c\r]", " ", text or ""))
    inner = {m.start() for m in _INNER.finditer(t)}
    t = _CAPITAL.sub(lambda m: (P if m.start() in inner else S) + m.group(), t)
    t = _UNIT.sub(lambda m: m[1] + U + m[2], _NUMBER.sub(lambda m: N + m.group(), t))
    t = regex.sub(rf"[^\p{{L}}\p{{N}}{N}-{S} ]+", "", t.lower())
    out = []
    for w in t.split(" "):
        plain = regex.sub(f"[{N}-{S}]", "", w)
        if not w:
            continue
        template = regex.sub(f"([{N}-{P}])[^{N}-{S} ]+", r"\1", w.replace(S, P))
        strict = regex.sub(f"([{N}-{P}])[^{N}-{S} ]+", r"\1", w.replace(S, ""))
        out.append((plain, template, strict))
    return out


def place(w):
    return bool(regex.search(f"[{N}-{P}]", w))


def brute(docs, items):
    out = {}
    for item, text in dict(items).items():
        words = reading(text)
        if item is None or not words:
            continue
        k = min(K, len(words))
        plain, open_, strict = (tuple(w[i] for w in words) for i in range(3))
        first = plain[0] if open_[0] == P else P if open_[0] == plain[0] and regex.fullmatch(r"\p{L}+", plain[0]) else open_[0]
        kinds = [open_, strict, (first, *open_[1:])]
        spots = defaultdict(set)  # template window to places in the item, with the words
        for b in range(len(words) - k + 1):
            for kind in kinds:
                w = kind[b : b + k]
                ordinary = sum(not place(x) for x in w)
                if ordinary < k and ordinary >= (1 if k == K else 2):
                    spots[w].add(b)
        whole = {plain[b : b + k] for b in range(len(words) - k + 1)}
        for doc, text_ in docs:
            if doc is None:
                continue
            said = reading(text_)
            dv, dt = tuple(w[0] for w in said), tuple(w[1] for w in said)
            copied = {dv[p : p + k] for p in range(len(said) - k + 1)} & whole
            met = [(p - b, b, w) for p in range(len(said) - k + 1) for w in [dt[p : p + k]] for b in spots.get(w, ())]
            if len(copied | {plain[b : b + k] for _, b, _ in met}) < SHARE * len(whole):
                continue
            slots = defaultdict(set)
            for shift, b, w in met:
                slots[shift].update((b + i, plain[b + i], dv[b + shift + i]) for i, x in enumerate(w) if place(x))
            fine = set()
            for shift, found in slots.items():
                ok = True
                for side in (1, 2):
                    by = defaultdict(Counter)
                    for s in found:
                        by[s[side]][s[3 - side]] += 1
                    ok &= sum(max(c.values()) for c in by.values()) >= SHARE * len(found)
                if ok:
                    fine.add(shift)
            standing = copied | {plain[b : b + k] for shift, b, _ in met if shift in fine}
            if len(standing) >= SHARE * len(whole):
                out[doc, item] = max(out.get((doc, item), (0, 0)), (len(standing), len(whole)))
    return out


NAMES = "Alice Bob Carol Dan Eve Frank Grace Heidi Ivan Judy".split()
SHAPES = (
    "{a} has {x} apples. {b} gives her {y} more. How many apples does {a} have now?", "A train leaves {a} at {x} and travels {y} km before it meets {b} near the old bridge.",
    "If {x} kg of rice cost {y} dollars, how much does {a} pay for {z} kg of it?", "{a} and {b} share {x} sweets. {a} eats {y} of them, and {b} eats {z}. Who has more left?",
    "In {x} minutes, {a} reads {y} pages; {b} needs {z} minutes. What is the ratio?",
)


def fill(shape, rnd):
    a, b = rnd.sample(NAMES, 2)
    x, y, z = rnd.sample(range(2, 900), 3)
    return shape.format(a=a, b=b, x=x, y=y, z=z)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7)))
    prose = lambda n: " ".join(word() if rnd.random() < 0.8 else rnd.choice([word().capitalize() + ".", str(rnd.randrange(99)), f"{rnd.randrange(50)} km", rnd.choice(NAMES)]) for _ in range(n))
    items = [(i, fill(s, rnd)) for i, s in enumerate(SHAPES)]
    items += [(10, "What is gravity?"), (11, "1 2 3 4 5 6 7 8 9"), (12, "Hello World Foo Bar Baz Qux Quux Corge"), (13, "Compute 5 plus 3"), (14, prose(40)), (15, " "), (16, None), (17, "Paris"), (None, "nobody knows what this may be")]
    docs = [(i, prose(60)) for i in range(30)]
    for n, shape in enumerate(SHAPES * 6):
        docs.append((100 + n, f"{prose(20)}. {fill(shape, rnd)} {prose(20)}"))
    for n, (_, text) in enumerate(i for i in items if i[1]):
        docs += [(200 + n, f"{prose(15)} {text} {prose(15)}"), (300 + n, f"{prose(9)} {text.upper()}  {prose(9)}"), (400 + n, text.lower().replace(" ", "\n"))]
    mixed = [(500, "Carol has 9 apples. Dan gives her 9 more. How many apples does Eve have now?"), (501, f"so alice has {SHAPES[0]}"), (502, "Compute 8 plus 8"), (503, None), (504, ""), (None, items[0][1])]
    return docs + mixed + [docs[31], (31, "another text of this id"), (32, items[9][1])], items


@pytest.mark.parametrize("seed, rows", [(1, 200_000), (2, 0)])
def test_leaks_equal_brute_force(spark, seed, rows):
    docs, items = corpus(seed)
    got = decontam.leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=rows).collect()
    assert {(r["doc_id"], r["item_id"]): (r["matched"], r["windows"]) for r in got} == brute(docs, items) and len(got) == len({(r["doc_id"], r["item_id"]) for r in got})
    found = {(r["doc_id"], r["item_id"]) for r in got}
    copies = [(100 + n, n % len(SHAPES)) for n in range(6 * len(SHAPES))]
    assert sum(c in found for c in copies) >= 0.95 * len(copies)
    planted = [(base + n, i) for base in (200, 300, 400) for n, (i, t) in enumerate(x for x in items if x[1]) if i is not None and t.strip()]
    assert [p for p in planted if p not in found] == []
    assert not any(d < 30 and i != 17 for d, i in found)


def test_slots_are_checked_both_ways(spark):
    item = "Mix 3 cups with 4 cups and 7 cups then stir it well"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = [(1, "Mix 9 cups with 9 cups and 9 cups then stir it well"), (2, "Mix 5 cups with 6 cups and 8 cups then stir it well"), (3, item)]
    assert sorted(r["doc_id"] for r in decontam.leaks(frame(spark, docs), bench).collect()) == [2, 3]


def test_long_texts_and_repeated_phrases(spark):
    item = "Put 5 red balls in the box and 5 blue balls in the bag"
    bench = spark.createDataFrame([(1, item), (2, "say it again and say it again and say it again")], "item_id long, text string")
    docs = [(1, "word " * 150_000 + item.replace("5", "8") + " word" * 150_000), (2, "say it again and " * 20_000), (3, "Put 1 red balls in the " * 5_000), (4, "x" * 1_000_000)]
    got = decontam.leaks(frame(spark, docs), bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (2, 2)]


def test_scratch_folder_is_the_one_that_is_named(spark):
    """Unset, a local session has a folder of its own; anything else raises."""
    from types import SimpleNamespace

    held = {}
    conf = SimpleNamespace(get=lambda k, d=None: held.get(k, d), set=held.__setitem__)
    for master, ok in (("local[4]", True), ("local", True), ("yarn", False), ("spark://host:7077", False), ("local-cluster[3,2,1024]", False), ("k8s://https://x", False)):
        held.clear()
        session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master), _jvm=spark._jvm)
        if ok:
            assert common.shared_root(session) == common.shared_root(session) == held["spark.checkpoint.dir"]
        else:
            with pytest.raises(RuntimeError):
                common.shared_root(session)
    assert common.shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
