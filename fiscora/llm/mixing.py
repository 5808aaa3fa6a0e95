"""Mixing sources to target weights, with DataFrame functions only.

Each row gets a hash-random key of its id and text.  The rows are range-sorted by source and key into ranges of about
`range_rows` rows; rows that are equal in all of this are told apart by a row number, so a hot id or text is cut into
ranges like any other rows.  Range totals give distributed prefix sums, and one window per range gives each row's place
in its source's random order.  A source takes whole epochs of its rows while its target allows and then the rows whose
words lie before the exact budget; the row on the cut gives a part of its words.

Defined cases: null text has size 0; a null source is a source of its own, last in order; null ids are ids like others;
rows of equal keys are ordered by id and size, and what is equal in these too is the same row for the result, so reruns
return the same rows whatever the partitioning; an empty table gives an empty result; other columns are neither read nor
returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: One word.  Java's regex and the contract's agree on it.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(spaced, " "), lambda w: w != "")).cast("long")


def random_key(ident: Column, text: Column, seed: int) -> Column:
    """60 random bits of an id and its text: the first 15 hexadecimal digits of an MD5, which any SQL engine can repeat."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(said.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Adds target to (source, source_size): weights go round by code point, null last; no target is above most * size.

    Sharing the excess again by weight until no source is above its bound ends at one level for all unbounded sources:
    with sources in order of bound / weight, the level after the first k are bounded is (all - bounds) / rest of weights.
    The window runs over one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    every = Window.partitionBy()
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    by_bound = Window.orderBy("_ratio", F.col("source").isNull(), F.col("source").cast("binary")).rowsBetween(Window.unboundedPreceding, -1)
    sized = (
        totals.withColumn("_w", F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int")))
        .withColumn("_bound", F.col("source_size") * F.lit(float(most)))
        .withColumn("_ratio", F.col("_bound") / F.col("_w"))
        .withColumn("_all", F.sum("source_size").over(every) * F.lit(float(share)))
    )
    stepped = sized.withColumn("_done", F.coalesce(F.sum("_bound").over(by_bound), F.lit(0.0))).withColumn(
        "_rest", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(by_bound), F.lit(0.0))
    )
    level = (F.col("_all") - F.col("_done")) / F.col("_rest")
    first_free = F.min_by(level, F.when(F.col("_ratio") > level, F.col("_ratio"))).over(every)
    return (
        stepped.withColumn("_level", first_free)
        .withColumn("target", F.least(F.col("_bound"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_bound"))))
        .select("source", "source_size", "source_rows", "target")
    )


def mix_sources(
    docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", range_rows: int = 100_000
) -> DataFrame:
    """(id, size, source_size, target, taken) of every row; taken counts words, repeats included."""
    ident, text = F.col(id_col), F.col(text_col)
    keyed = docs.select(
        ident.alias("_id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"), random_key(ident, text, seed).alias("_key"), F.monotonically_increasing_id().alias("_row")
    )
    sized = materialise(keyed, "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    targets = materialise(source_targets(totals, weights, share, most), "mix-targets").withColumnRenamed("source", "_source")
    ranges = max(1, -(-sized.count() // range_rows))
    sorted_ = sized.repartitionByRange(ranges, "source", "_key", "_id", "size", "_row").withColumn("_range", F.spark_partition_id())
    ranged = materialise(sorted_, "mix-ranges")  # a range is a fixed column from here on
    keyed = ranged.join(targets.drop("source_rows"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("source", "_range").agg(F.sum("size").alias("_total"))
        .withColumn("_start", F.coalesce(F.sum("_total").over(before), F.lit(0)))
        .select(F.col("source").alias("_source"), F.col("_range").alias("_at"), "_start")
    )
    within = Window.partitionBy("source", "_range").orderBy("_key", "_id", "size", "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_at"))
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budget = F.round(F.col("target") - epochs * F.col("source_size")).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("size"), budget - F.col("_start") - F.col("_before")))
    return placed.select(
        F.col("_id").alias(id_col), "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken")
    )
