"""Audit of a published flag against a predicate on independent columns (C01; G02, G03, G09, G10)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import PredicateError, derived_flag
from ..functions.values import FALSE_WORDS, TRUE_WORDS, flag, is_blank, to_number
from ..report import Report, encode, sample


def measured(df: DataFrame, measures: list[str], year: str, flag_column: Column) -> DataFrame:
    """year, flag (boolean or null) and the measures as numbers."""
    kinds = dict(df.dtypes)
    return df.select(df[year].alias("year"), flag_column.alias("flag"), *[to_number(df[m], kinds[m]).alias(m) for m in measures])


def year_flag_sums(work: DataFrame, measures: list[str], scale: int | None = None) -> DataFrame:
    """Rows (n) and sums by year and flag, nulls included: all that summary and conservation need, in one pass."""
    kind = "double" if scale is None else f"decimal(28,{scale})"
    return work.groupBy("year", "flag").agg(F.count("*").alias("n"), *[F.sum(F.col(m).cast(kind)).alias(m) for m in measures])


def partition_summary(sums: DataFrame, measures: list[str]) -> DataFrame:
    """Rows and sums by year and flag, where both are known."""
    known = sums.filter(F.col("year").isNotNull() & F.col("flag").isNotNull())
    return known.select("year", "flag", F.col("n").alias("rows"), *[F.col(m).cast("double").alias(m) for m in measures])


def conservation(sums: DataFrame, measures: list[str]) -> DataFrame:
    """All rows and sums of a year against those with a flag.

    A year without any flagged row has a partitioned sum of 0; a null sum has a null difference.
    """
    flagged = F.col("flag").isNotNull()
    parts = sums.filter("year is not null").groupBy("year").agg(
        F.sum("n").alias("all_rows"), F.coalesce(F.sum(F.when(flagged, F.col("n"))), F.lit(0)).alias("partitioned_rows"),
        *[x for m in measures for x in (F.sum(m).cast("double").alias(f"{m}_all"), F.sum(F.when(flagged, F.col(m))).cast("double").alias(f"{m}_some"))],
    )
    out = ["year", "all_rows", "partitioned_rows", (F.col("all_rows") - F.col("partitioned_rows")).alias("row_difference")]
    for m in measures:
        some = F.when(F.col("partitioned_rows") == 0, F.lit(0.0)).otherwise(F.col(f"{m}_some"))
        out += [F.col(f"{m}_all"), some.alias(f"{m}_partitioned"), (F.col(f"{m}_all") - some).alias(f"{m}_difference")]
    return parts.select(*out)


def audit_flags(
    df: DataFrame, measures: list[str], id_columns: list[str], predicate: dict | None = None, flag_column: str = "is_foreign", expected_column: str | None = None, year_column: str = "year",
    source_rule: str | None = None, allow_null_flag: bool = False, allow_null_measures: bool = False, require_both_values: bool = False, tolerance: float = 0.01, sample_limit: int = 25, scale: int | None = None,
) -> Report:
    """C01.  Without a predicate the audit cannot pass.

    allow_null_flag lets null flags be, but they still leave their year unpartitioned, which blocks.
    """
    if tolerance < 0:
        raise ValueError("the tolerance must not be negative")
    if expected_column == flag_column:
        raise ValueError("the expected flag must be another column than the flag")
    if predicate is not None and not id_columns:
        raise ValueError("an independent predicate requires id columns")
    needed = {flag_column, year_column, *measures, *id_columns, *([expected_column] if expected_column else [])}
    if missing := sorted(needed - set(df.columns)):
        raise ValueError(f"input is missing required columns: {missing}")
    kinds, derived, used = dict(df.dtypes), None, []
    if predicate is not None:
        try:
            derived, used = derived_flag(df, predicate, {flag_column, *([expected_column] if expected_column else [])})
        except PredicateError as e:
            return Report("foreign_funding", [f"invalid independent predicate: {e}"])
    out = flag(df[flag_column])
    supplied = flag(df[expected_column]) if expected_column else None
    expected = F.struct(F.lit("valid").alias("status"), derived.alias("value")) if derived is not None else supplied
    yes_valid = lambda c: c["status"] == "valid"
    mismatch = (yes_valid(out) & yes_valid(expected) & (out["value"] != expected["value"])) if expected is not None else F.lit(False)
    disagree = (yes_valid(supplied) & (supplied["value"] != derived)) if supplied is not None and derived is not None else F.lit(False)
    incomplete = reduce(or_, [is_blank(df[c]) for c in id_columns], F.lit(False))

    def counted(prefix: str, c: Column | None) -> list[Column]:
        return [] if c is None else [F.count_if(c["status"] == s).alias(f"{prefix}_{s}") for s in ("valid", "null", "invalid")]

    per_measure = []
    for m in measures:
        number = to_number(df[m], kinds[m])
        per_measure += [F.count_if(df[m].isNull()).alias(f"null:{m}"), F.count_if(df[m].isNotNull() & number.isNull()).alias(f"bad:{m}")]
    seen = df.agg(
        F.count("*").alias("rows"), F.count_if(df[year_column].isNull()).alias("null_year"), *counted("out", out), *counted("expected", expected), *counted("supplied", supplied),
        F.count_if(F.coalesce(mismatch, F.lit(False))).alias("mismatch"), F.count_if(F.coalesce(disagree, F.lit(False))).alias("disagree"), F.count_if(incomplete).alias("incomplete"),
        F.max(F.when(df[year_column].isNotNull(), out["value"])).alias("most"), F.min(F.when(df[year_column].isNotNull(), out["value"])).alias("least"), *per_measure,
    ).first().asDict()
    repeated = 0
    if id_columns:
        groups = df.groupBy(*id_columns).agg(F.count("*").alias("n")).filter("n > 1")
        repeated = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    blockers: list[str] = []

    def block(n: int, what: str) -> None:
        if n:
            blockers.append(f"{n} row(s) {what}")

    if predicate is None:
        blockers.append("an independent predicate is required for a passing audit")
    block(seen["null_year"], "have a null year")
    block(seen["out_invalid"], "have an invalid output flag")
    if not allow_null_flag:
        block(seen["out_null"], "have a null output flag")
    block(seen["incomplete"], "have an incomplete stable id")
    block(repeated, "have a duplicate stable id")
    if supplied is not None:
        block(seen["supplied_invalid"], "have an invalid expected flag")
        if not allow_null_flag:
            block(seen["supplied_null"], "have a null expected flag")
    block(seen["disagree"], "have an expected flag that disagrees with the predicate")
    block(seen["mismatch"], "disagree with the derived flag")
    for m in measures:
        block(seen[f"bad:{m}"], f"have a non-numeric {m}")
        if not allow_null_measures:
            block(seen[f"null:{m}"], f"have a null {m}")
    values = sorted({v for v in (seen["least"], seen["most"]) if v is not None})
    if require_both_values and values != [False, True]:
        blockers.append("the output flag does not hold both false and true")
    sums = year_flag_sums(measured(df, measures, year_column, out["value"]), measures, scale).persist()  # a few rows
    kept, summary = conservation(sums, measures), partition_summary(sums, measures)
    kept_rows = [r.asDict() for r in kept.orderBy("year").collect()]
    for r in kept_rows:
        if r["row_difference"]:
            blockers.append(f"year {r['year']} has {r['row_difference']} unpartitioned row(s)")
        for m in measures:
            d = r[f"{m}_difference"]
            if d is not None and abs(d) > tolerance:
                blockers.append(f"year {r['year']} {m} does not conserve by {d}")
    detail_columns = [*[df[c] for c in id_columns], df[flag_column].alias("output_flag_raw"), out["status"].alias("output_flag_status"), out["value"].alias("output_flag_normalized")]
    if expected is not None:
        detail_columns += [expected["status"].alias("expected_flag_status"), expected["value"].alias("expected_flag_normalized"), F.coalesce(mismatch, F.lit(False)).alias("flag_mismatch")]
    if supplied is not None and derived is not None:
        detail_columns.append(F.coalesce(disagree, F.lit(False)).alias("provided_expected_predicate_mismatch"))
    detail = df.select(*detail_columns)
    facts = {
        "rows": seen["rows"], "flag_column": flag_column, "provided_expected_flag_column": expected_column, "source_rule": source_rule or (predicate or {}).get("description"), "predicate_columns": used,
        "independent_predicate_used": predicate is not None, "accepted_flag_encodings": {"true": list(TRUE_WORDS), "false": list(FALSE_WORDS)},
        "flag_quality": {"valid_rows": seen["out_valid"], "null_rows": seen["out_null"], "invalid_rows": seen["out_invalid"], "observed_boolean_values": values},
        "measure_quality": {m: {"null_rows": seen[f"null:{m}"], "invalid_rows": seen[f"bad:{m}"]} for m in measures}, "mismatch_rows": seen["mismatch"],
        "provided_expected_predicate_mismatch_rows": seen["disagree"], "partition_summary": [encode(r.asDict()) for r in summary.orderBy("year", "flag").collect()], "conservation": encode(kept_rows),
    }
    tables = {"detail": detail, "partition_summary": summary, "conservation": kept}
    if id_columns:
        bad = detail.filter("output_flag_status <> 'valid'")
        facts["invalid_or_null_flag_sample"] = sample(bad, id_columns, sample_limit) if seen["out_null"] + seen["out_invalid"] else []
        facts["mismatch_sample"] = sample(detail.filter("flag_mismatch"), id_columns, sample_limit) if seen["mismatch"] else []
    return Report("foreign_funding", blockers, facts, tables)
