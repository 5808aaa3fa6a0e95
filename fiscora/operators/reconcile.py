"""Reconciliation of two tables within tolerances (C03; J01, P07, G01, G08, G12)."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import exact_sum, safe_ratio, to_number
from ..report import Report, sample

STATUSES = ("MATCH", "DISCREPANCY", "MISSING_LEFT", "MISSING_RIGHT")
#: The wider set of outcomes that a report to reviewers uses, from ours and the kind of the reference.
TAXONOMY = ("MATCH", "DISCREPANCY", "MISSING_REFERENCE", "MISSING_PIPELINE", "BOTH_MISSING", "UNSUPPORTED_REFERENCE", "EXPECTED_EXCLUSION")


def keyed_sums(df: DataFrame, keys: list[str], value: str, name: str, scale: int | None = None) -> DataFrame:
    """Null keys are a group; a sum of nothing but nulls is null."""
    return df.groupBy(*keys).agg(exact_sum(to_number(df[value], dict(df.dtypes)[value]), scale).alias(name))


def input_quality(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """G08 in one row: rows, and rows with duplicate keys, null keys, invalid values and null values.

    Duplicates are counted from group sizes, which needs no window: partial counts go through the shuffle.
    """
    raw = df[value]
    number = to_number(raw, dict(df.dtypes)[value])
    null_key = reduce(lambda a, b: a | b, [df[k].isNull() for k in keys])
    groups = df.groupBy(*[F.col(k) for k in keys]).agg(
        F.count("*").alias("n"), F.count_if(null_key).alias("nk"), F.count_if(raw.isNotNull() & number.isNull()).alias("iv"), F.count_if(raw.isNull()).alias("nv")
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return groups.agg(
        total("n").alias("rows"), total(F.when(F.col("n") > 1, F.col("n"))).alias("duplicate_key_rows"), total("nk").alias("null_key_rows"),
        total("iv").alias("invalid_value_rows"), total("nv").alias("null_value_rows"),
    )


def duplicated_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key another row has too; null keys are equal.

    The repeated keys are counted and joined back: adaptive execution broadcasts them or splits a hot one, a window cannot.
    """
    marks = [f"_key_{i}" for i in range(len(keys))]
    repeated = df.groupBy(*[F.col(k).alias(m) for k, m in zip(keys, marks)]).agg(F.count("*").alias("_n_of_key")).filter("_n_of_key > 1").drop("_n_of_key")
    return df.join(repeated, reduce(and_, [F.col(k).eqNullSafe(F.col(m)) for k, m in zip(keys, marks)]), "left_semi")


def compare(
    left: DataFrame, right: DataFrame, keys: list[str], left_value: str, right_value: str, absolute: float = 0.5, relative: float = 0.05, denominator: str = "right", scale: int | None = None
) -> DataFrame:
    """keys, left_value, right_value, absolute_difference, relative_difference, status of every key of either side."""
    a = keyed_sums(left, keys, left_value, "left_value", scale).withColumn("_in_left", F.lit(True)).alias("a")
    b = keyed_sums(right, keys, right_value, "right_value", scale).withColumn("_in_right", F.lit(True)).alias("b")
    met = a.join(b, reduce(and_, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]), "full_outer")
    l, r = F.col("left_value"), F.col("right_value")
    base: Column = {"left": F.abs(l), "right": F.abs(r), "max": F.greatest(F.abs(l), F.abs(r))}[denominator]
    rows = met.select(
        *[F.when(F.col("_in_left"), F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in keys], "left_value", "right_value",
        (l - r).alias("absolute_difference"), safe_ratio(F.abs(l - r), base).alias("relative_difference"), "_in_left", "_in_right",
    )
    # a null on a key that both sides have meets no tolerance: a discrepancy, also where null values are allowed
    status = (
        F.when(F.col("_in_right").isNull(), "MISSING_RIGHT").when(F.col("_in_left").isNull(), "MISSING_LEFT")
        .when(F.abs("absolute_difference") <= absolute, "MATCH").when(F.col("relative_difference") <= relative, "MATCH").otherwise("DISCREPANCY")
    )
    return rows.withColumn("status", status).drop("_in_left", "_in_right")


def status_counts(detail: DataFrame) -> DataFrame:
    return detail.groupBy("status").agg(F.count("*").alias("n"))


def taxonomy(detail: DataFrame, unsupported: Column | None = None, excluded: Column | None = None) -> DataFrame:
    """Adds `outcome`, one of TAXONOMY; left is the pipeline, right the reference."""
    none = F.lit(False)
    outcome = (
        F.when(excluded if excluded is not None else none, "EXPECTED_EXCLUSION").when(unsupported if unsupported is not None else none, "UNSUPPORTED_REFERENCE")
        .when(F.col("left_value").isNull() & F.col("right_value").isNull(), "BOTH_MISSING")
        .when(F.col("status") == "MISSING_LEFT", "MISSING_PIPELINE").when(F.col("status") == "MISSING_RIGHT", "MISSING_REFERENCE").otherwise(F.col("status"))
    )
    return detail.withColumn("outcome", outcome)


def reconcile(
    left: DataFrame, right: DataFrame, keys: list[str], left_value: str, right_value: str, absolute: float = 0.5, relative: float = 0.05, denominator: str = "right", allow_status: tuple[str, ...] = (),
    duplicate_key_reason: str | None = None, null_value_reason: str | None = None, sample_limit: int = 25, scale: int | None = None,
) -> Report:
    """C03.  A reason waives duplicate keys or null values; null keys and invalid values are never waived."""
    if not keys:
        raise ValueError("at least one key is required")
    for side, df, value in (("left", left, left_value), ("right", right, right_value)):
        if missing := sorted({*keys, value} - set(df.columns)):
            raise ValueError(f"{side} is missing columns {missing}")
    detail = compare(left, right, keys, left_value, right_value, absolute, relative, denominator, scale).persist()  # counted, sampled, and often written
    counts = {r["status"]: r["n"] for r in status_counts(detail).collect()}
    quality = {side: input_quality(df, keys, v).first().asDict() for side, df, v in (("left", left, left_value), ("right", right, right_value))}
    waived = {"duplicate_key_rows": duplicate_key_reason, "null_value_rows": null_value_reason}
    quality_blockers = [f"{side} has {q[k]} {k.replace('_', ' ')}" for side, q in quality.items() for k in q if k != "rows" and q[k] and not waived.get(k)]
    blocking = [s for s in STATUSES[1:] if s not in allow_status]
    blocked = detail.filter(F.col("status").isin(*blocking))
    found = [f"{counts[s]} {s} row(s)" for s in blocking if counts.get(s)]
    facts = {
        "keys": keys, "left_rows": quality["left"].pop("rows"), "right_rows": quality["right"].pop("rows"), "input_quality": quality, "quality_blockers": quality_blockers,
        "quality_exceptions": {"duplicate_keys": duplicate_key_reason, "null_values": null_value_reason}, "comparison_rows": sum(counts.values()), "status_counts": counts,
        "tolerances": {"absolute": absolute, "relative": relative, "denominator": denominator}, "allowed_statuses": list(allow_status),
        "blocking_sample": sample(blocked, keys, sample_limit) if found else [],
    }
    return Report("reconciliation", found + quality_blockers, facts, {"detail": detail, "blocking": blocked})
