"""Benchmark decontamination by template windows, with DataFrame functions only.

A text has two readings, word by word: the plain one (lower-cased, without punctuation) and the template, where numbers,
units after numbers, and names (capitalised words) are typed placeholders.  Windows of `k` words of both are hashed and
joined with the benchmark's; an item's window is held where one of its readings is met.  As a capitalised word may be an
ordinary one that starts a sentence, an item has two more readings: a template that leaves words at a sentence start as
they are, and one that takes its first word the other way.  A template window counts where it holds an ordinary word; a
window of placeholders alone is known by its plain words.  An item of fewer than k words is one window of its own length,
looked for in every text; its template counts with two ordinary words or more.

A pair of document and item is a candidate when the document holds `share` or more of the item's distinct windows.  Of
these, plain copies of windows stand by themselves.  Template windows stand only in consistent alignments (differences of
position): over the slots that an alignment meets, equal values of the item must meet equal values of the document, and
equal values of the document those of the item, in `share` of the slots either way.  The pair is a leak when the windows
that stand are `share` of the item's.  So re-parameterised copies are found and chance templates are not.

Defined cases: null texts and texts without a word hold no windows, and such items are matched by nothing; repeated rows
of an item count as one; rows that repeat an id with different texts are judged each by its own text, and the pair is
returned once with the largest count; rows of null ids (document or item) give none; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

# Private-use characters that mark numbers, units, names and capitalised words at a sentence start; units.
NUMBER, UNIT, NAME, START = "", "", "", ""
UNITS = "kg|g|mg|lb|lbs|oz|t|km|m|cm|mm|mi|ft|in|l|ml|s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|miles?|meters?|metres?|dollars?|euros?|cents?|percent|degrees?|kmh|mph|w|kw|v|hz"
_END = r"(?![\p{L}\p{N}])"
# In these patterns the rarest test comes first, as they run over whole texts.  Digits within a word are a part of it.
_DIGITS = r"\p{Nd}+(?:[.,:/-]\p{Nd}+)*"
_NUMBER = r"\p{Nd}(?<![\p{L}\p{N}]\p{Nd})\p{Nd}*(?:[.,:/-]\p{Nd}+)*(?=(?i:" + UNITS + f")?{_END})"
_MEASURE = f"({NUMBER}{_DIGITS} ?)((?i:{UNITS})){_END}"
_INNER_NAME = r"\p{Lu}(?<=[\p{L}\p{N},;:] \p{Lu})\p{Ll}+" + _END
_CAPITAL = r"\p{Lu}(?<![\p{L}\p{N}" + NAME + r"]\p{Lu})\p{Ll}+" + _END
_PLACE = f"[{NUMBER}{UNIT}{NAME}]"


def _plain(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), f"\t\n\x0b\x0c\r{NUMBER}{UNIT}{NAME}{START}", "     ")


def _marked(text: Column, starts: bool = False) -> Column:
    """The lower-cased text without punctuation, with a mark before each number, unit and name.

    starts: capitalised words at a sentence start have a mark of their own.
    """
    t = _plain(text)
    if starts:
        t = F.regexp_replace(t, _INNER_NAME, NAME + "$0")
    t = F.regexp_replace(t, _CAPITAL, (START if starts else NAME) + "$0")
    t = F.regexp_replace(t, _NUMBER, NUMBER + "$0")
    t = F.regexp_replace(t, _MEASURE, "$1" + UNIT + "$2")
    return F.regexp_replace(F.lower(t), f"[^a-z \\p{{L}}\\p{{N}}{NUMBER}-{START}]+", "")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda w: w != "")


def _values(marked: Column) -> Column:
    """Plain words of a marked text."""
    return _words(F.translate(marked, NUMBER + UNIT + NAME + START, ""))


def _template(marked: Column) -> Column:
    """Template words of a text marked without `starts`: what follows a mark, up to the next or the word's end, goes."""
    return _words(F.regexp_replace(marked, f"([{NUMBER}-{NAME}])[^{NUMBER}-{START} ]+", "$1"))


def value_words(text: Column) -> Column:
    return _values(_marked(text))


def template_words(text: Column) -> Column:
    """Template words of a text, one for each word of `value_words`; words at a sentence start are no names."""
    return _template(F.translate(_marked(text, True), START, ""))


def open_template_words(text: Column) -> Column:
    """The same with all capitalised words as names."""
    return _template(_marked(text))


def hashes(words: Column) -> Column:
    """A hash of each word.  Windows are hashed from these, which costs a fifth of cutting the words out."""
    return F.transform(words, lambda w: F.xxhash64(w))


def window(hashed: Column, at: Column, k: int) -> Column:
    """Hash of the k words from the place `at` (from 0) on; places beyond the end add nothing."""
    return F.xxhash64(*[F.get(hashed, at + j) for j in range(k)])


def windows(hashed: Column, k: int) -> Column:
    """Hashes of the windows of k words, in order, from a column of word hashes; fewer words have none."""
    every = F.transform(hashed, lambda _, i: window(hashed, i, k))
    return F.when(F.size(hashed) >= k, F.slice(every, 1, F.size(hashed) - (k - 1))).otherwise(F.array().cast("array<bigint>"))


def _small(df: DataFrame, most: int) -> DataFrame:
    """Marked for broadcast where it has `most` rows at most; df is a written table, so counting is cheap."""
    return F.broadcast(df) if df.count() <= most else df


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_doc, _text_key, plain words _v, template _t, and their hashes), as columns, so that lambdas do not make them anew."""
    marked = docs.select(F.col(id_col).alias("_doc"), F.xxhash64(F.col(text_col)).alias("_text_key"), _marked(F.col(text_col)).alias("_m"))
    words = marked.select("_doc", "_text_key", _values(F.col("_m")).alias("_v"), _template(F.col("_m")).alias("_t"))
    return words.select("*", hashes(F.col("_v")).alias("_hv"), hashes(F.col("_t")).alias("_ht"))


def _item_windows(benchmark: DataFrame, k: int, item_col: str, text_col: str) -> DataFrame:
    """A row for each window of each item and each reading that counts: its hash, place, length and words.

    _g names the window: the hash of its plain words.
    """
    text = F.col(text_col)
    words = benchmark.filter(F.col(item_col).isNotNull()).select(
        F.col(item_col).alias("_item"), value_words(text).alias("_v"), open_template_words(text).alias("_t"), template_words(text).alias("_u")
    ).filter(F.size("_v") > 0)
    first, said = F.col("_t")[0], F.col("_v")[0]
    turned = F.when(first == NAME, said).when((first == said) & said.rlike(r"^\p{L}+$"), F.lit(NAME)).otherwise(first)
    words = words.withColumn("_f", F.concat(F.array(turned), F.slice("_t", 2, F.size("_t")))).withColumn("_k", F.least(F.size("_v"), F.lit(k)))
    kinds = ("_v", "_t", "_u", "_f")
    placed = words.select("*", F.explode(F.sequence(F.lit(0), F.size("_v") - F.col("_k"))).alias("_b"))
    cut = placed.select("_item", "_b", "_k", *[F.slice(c, F.col("_b") + 1, F.col("_k")).alias(c) for c in kinds])
    cut = cut.withColumns({f"_h{c}": window(hashes(F.col(c)), F.lit(0), k) for c in kinds}).withColumn("_g", F.col("_h_v"))
    ordinary = lambda c: F.size(F.filter(c, lambda w: ~w.rlike(_PLACE)))
    rows = [cut.select("_item", "_b", "_k", "_g", F.col("_h_v").alias("_h"), F.lit(False).alias("_slots"), F.col("_v").alias("_w"), "_v")]
    for c in kinds[1:]:
        counts = (F.size(c) > ordinary(F.col(c))) & (ordinary(F.col(c)) >= F.when(F.col("_k") < k, 2).otherwise(1))
        rows.append(cut.filter(counts).select("_item", "_b", "_k", "_g", F.col(f"_h{c}").alias("_h"), F.lit(True).alias("_slots"), F.col(c).alias("_w"), "_v"))
    return reduce(DataFrame.unionByName, rows)


def leaks(
    docs: DataFrame, benchmark: DataFrame, k: int = 5, share: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", broadcast_rows: int = 200_000
) -> DataFrame:
    """(id, item id, matched, windows, coverage) of every pair of a document and an item it leaks."""
    spots = materialise(_item_windows(benchmark, k, item_col, item_text_col).distinct(), "leak-items")
    #: lengths of windows: k, and those under k that an item has
    spans = sorted({k} | {r["_k"] for r in spots.select("_k").distinct().collect()})
    totals = spots.groupBy("_item").agg(F.countDistinct("_g").alias("_total"))
    wanted = _small(materialise(spots.select("_item", "_g", "_h").distinct(), "leak-windows"), broadcast_rows)
    read = _read(docs.filter(F.col(id_col).isNotNull()), id_col, text_col).select("_doc", "_text_key", "_hv", "_ht")
    none = F.array().cast("array<bigint>")
    # a template that is the plain reading adds nothing
    every = [w for s in spans for w in (windows(F.col("_hv"), s), F.when(F.col("_ht") == F.col("_hv"), none).otherwise(windows(F.col("_ht"), s)))]
    # explode_outer: for explode, the optimizer would add a filter that computes the array a second time
    held = read.select("_doc", "_text_key", F.explode_outer(F.concat(*every)).alias("_w"))
    hits = held.join(wanted, F.col("_w") == F.col("_h")).groupBy("_doc", "_text_key", "_item").agg(F.countDistinct("_g").alias("_matched"))
    enough = lambda c: F.col(c) >= F.lit(share) * F.col("_total")
    pairs = materialise(hits.join(totals, "_item").filter(enough("_matched")).select("_doc", "_text_key", "_item", "_total"), "leak-pairs")
    found = _standing(docs, spots, pairs, spans, share, id_col, text_col, broadcast_rows)
    kept = pairs.join(found, ["_doc", "_text_key", "_item"]).filter(enough("_found"))
    best = kept.groupBy("_doc", "_item").agg(F.max("_found").alias("_found"), F.first("_total").alias("_total"))
    return best.select(
        F.col("_doc").alias(id_col), F.col("_item").alias(item_col), F.col("_found").alias("matched"), F.col("_total").alias("windows"), (F.col("_found") / F.col("_total")).alias("coverage")
    )


def _standing(docs: DataFrame, spots: DataFrame, pairs: DataFrame, spans: list[int], share: float, id_col: str, text_col: str, broadcast_rows: int) -> DataFrame:
    """(_doc, _text_key, _item, _found): how many of the item's windows stand in the text, of the candidate pairs.

    Only places that meet a window with slots are aligned, and only in texts and with items of candidate pairs, so rows
    are places of a template window in the text times its places in the item.
    """
    ids = _small(materialise(pairs.select(F.col("_doc").alias("_a"), F.col("_text_key").alias("_b")).distinct(), "leak-docs"), broadcast_rows)
    texts = docs.join(ids, (F.col(id_col) == F.col("_a")) & (F.xxhash64(F.col(text_col)) == F.col("_b")), "left_semi")
    words = materialise(_read(texts, id_col, text_col).distinct(), "leak-words")
    key, pair = ["_doc", "_text_key"], ["_doc", "_text_key", "_item"]
    plain = words.select(*key, F.explode(F.array_distinct(F.concat(*[windows(F.col("_hv"), s) for s in spans]))).alias("_h"))
    bare = spots.filter("not _slots").select("_item", "_g", "_h").distinct()
    copied = plain.join(bare, "_h").join(pairs.select(*pair), pair, "left_semi").select(*pair, "_g")
    places = reduce(DataFrame.unionByName, [words.select(*key, F.posexplode(windows(F.col("_ht"), s)).alias("_p", "_h")) for s in spans])
    slotted = spots.filter("_slots").select("_item", "_b", "_k", "_g", "_h", "_w", "_v")
    met = (
        places.join(slotted, "_h").join(pairs.select(*pair), pair, "left_semi")
        .join(words.select(*key, F.col("_v").alias("_dv")), key)
        .select(*pair, (F.col("_p") - F.col("_b")).alias("_shift"), "_b", "_g", "_w", "_v", F.slice("_dv", F.col("_p") + 1, F.col("_k")).alias("_dv"))
    )
    met = materialise(met, "leak-met")
    at = F.explode(F.arrays_zip(F.transform("_w", lambda w, i: F.col("_b") + i).alias("at"), F.col("_w").alias("w"), F.col("_v").alias("v"), F.col("_dv").alias("d"))).alias("_z")
    slots = met.select(*pair, "_shift", at).filter(F.col("_z.w").rlike(_PLACE)).select(*pair, "_shift", F.col("_z.at").alias("_at"), F.col("_z.v").alias("_iv"), F.col("_z.d").alias("_tv")).distinct()
    counts = slots.groupBy(*pair, "_shift", "_iv", "_tv").agg(F.count("*").alias("_n"))

    def agreeing(value: str) -> DataFrame:
        """Slots of each alignment, and those whose value of one side meets its most frequent counterpart."""
        most = counts.groupBy(*pair, "_shift", value).agg(F.max("_n").alias("_most"), F.sum("_n").alias("_all"))
        return most.groupBy(*pair, "_shift").agg((F.sum("_most") >= F.lit(share) * F.sum("_all")).alias(f"_ok{value}"))

    fine = agreeing("_iv").join(agreeing("_tv"), [*pair, "_shift"]).filter("_ok_iv and _ok_tv").select(*pair, "_shift")
    templated = met.join(fine, [*pair, "_shift"], "left_semi").select(*pair, "_g")
    return copied.unionByName(templated).groupBy(*pair).agg(F.countDistinct("_g").alias("_found"))
