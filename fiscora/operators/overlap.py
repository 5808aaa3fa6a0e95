"""Overlap of tagging rules: pairs, net excess and doubles within a rule (C02; G04-G07, J02, J04, B11).

Each group of competing codes becomes bits of the codes a row meets, and rows are summed by group, bits and year before
anything else: what is shuffled is a row for each set of codes that occurs, whatever the size of the table.  Pairs, totals
and excess are then exploded from those few rows.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import Rule, compile_rule, dispatched, masks_by_code
from ..functions.values import exact_sum, safe_ratio, to_number
from ..report import Report, encode

SUBNATIONAL = ("_SBN_", "^SBN_")
Group = tuple[str, str, str]


def levels(row: dict) -> list[tuple[str, str]]:
    """Of each dimension the finer level that the code names."""
    out = []
    for dim in ("econ", "func"):
        if row.get(dim) not in (None, ""):
            fine = row.get(f"{dim}_sub")
            out.append((dim, str(row[dim])) if fine in (None, "") else (f"{dim}_sub", str(fine)))
    return out


def candidate_groups(dictionary: list[dict], patterns: tuple[str, ...] = SUBNATIONAL) -> dict[Group, dict[str, str]]:
    """(scope, kind, level) to code to value: codes that compete for the same rows."""
    groups: dict[Group, dict[str, str]] = {}
    for row in dictionary:
        if row.get("code"):
            scope = "subnational" if any(re.search(p, row["code"]) for p in patterns) else "primary"  # P12
            for level, value in levels(row):
                groups.setdefault((scope, row.get("tag_kind") or "", level), {})[row["code"]] = value
    return groups


#: Codes that one long holds as bits.
WORD_BITS = 62


def _numbers(df: DataFrame, measures: list[str]) -> list[Column]:
    kinds = dict(df.dtypes)
    return [F.coalesce(to_number(df[m], kinds[m]), F.lit(0.0)).alias(f"m_{m}") for m in measures]


def _bits(masks: list[Column]) -> Column:
    words = [masks[i : i + WORD_BITS] for i in range(0, len(masks), WORD_BITS)]
    return F.array(*[reduce(add, [F.when(m, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, m in enumerate(w)]) for w in words])


def memberships(df: DataFrame, masks: dict[str, Column], groups: dict[Group, dict[str, str]], measures: list[str], year: str | None, scale: int | None = None) -> DataFrame:
    """scope, tag_kind, level, codes (sorted array), year, n, m_<measure>: a row for each set of codes that rows of a year meet."""
    listed = [(g, sorted(c for c in members if c in masks)) for g, members in sorted(groups.items())]
    listed = [(g, codes) for g, codes in listed if codes]
    years = df[year].cast("string") if year and year in df.columns else F.lit(None).cast("string")
    none = F.struct(F.lit(-1).alias("i"), F.array().cast("array<bigint>").alias("bits"))
    arrays = [F.struct(F.lit(i).alias("i"), _bits([masks[c] for c in codes]).alias("bits")) for i, (_, codes) in enumerate(listed)] or [none]
    # the arrays are a column of their own, so that the masks are evaluated once
    work = df.select(F.array(*arrays).alias("g"), years.alias("year"), *_numbers(df, measures))
    flat = work.select(F.explode("g").alias("g"), "year", *[f"m_{m}" for m in measures]).filter(F.exists("g.bits", lambda b: b != 0))
    kind = "double" if scale is None else f"decimal(28,{scale})"
    summed = flat.groupBy("g.i", "g.bits", "year").agg(F.count("*").alias("n"), *[F.sum(F.col(f"m_{m}").cast(kind)).alias(f"m_{m}") for m in measures])

    def held(codes: list[str]) -> Column:
        bit = lambda k: F.col("bits")[k // WORD_BITS].bitwiseAND(F.lit(1 << k % WORD_BITS)) != 0
        return F.array_compact(F.array(*[F.when(bit(k), F.lit(c)) for k, c in enumerate(codes)]))

    name = lambda part: reduce(lambda rest, at: F.when(F.col("i") == at[0], F.lit(at[1][0][part])).otherwise(rest), enumerate(listed), F.lit(None).cast("string"))
    codes = reduce(lambda rest, at: F.when(F.col("i") == at[0], held(at[1][1])).otherwise(rest), enumerate(listed), F.array().cast("array<string>"))
    return summed.select(name(0).alias("scope"), name(1).alias("tag_kind"), name(2).alias("level"), codes.alias("codes"), "year", "n", *[f"m_{m}" for m in measures])


def _pairs(met: DataFrame) -> DataFrame:
    two = F.flatten(F.transform("codes", lambda a: F.transform(F.filter("codes", lambda b: b > a), lambda b: F.struct(a.alias("code_a"), b.alias("code_b")))))
    return met.filter(F.size("codes") > 1).withColumn("p", F.explode(two)).select("*", "p.code_a", "p.code_b").drop("p", "codes")


def code_totals(met: DataFrame, measures: list[str], scale: int | None = None) -> DataFrame:
    codes = met.withColumn("code", F.explode("codes"))
    return codes.groupBy("scope", "tag_kind", "level", "code").agg(F.sum("n").alias("rows"), *[exact_sum(F.col(f"m_{m}"), scale).alias(m) for m in measures])


def pair_overlaps(met: DataFrame, measures: list[str], by_year: bool = False, scale: int | None = None) -> DataFrame:
    """Overlap of two codes in all, with its ratio to the smaller of their totals, or by year."""
    keys = ["scope", "tag_kind", "level", "code_a", "code_b"]
    sums = [exact_sum(F.col(f"m_{m}"), scale).alias(f"{m}_overlap") for m in measures]
    found = _pairs(met).groupBy(*keys, *(["year"] if by_year else [])).agg(F.sum("n").alias("rows"), *sums)
    if by_year:
        return found
    totals = code_totals(met, measures, scale).drop("rows")
    side = lambda s: totals.select("scope", "tag_kind", "level", F.col("code").alias(f"code_{s}"), *[F.col(m).alias(f"{m}_{s}") for m in measures])
    met_both = found.join(side("a"), ["scope", "tag_kind", "level", "code_a"]).join(side("b"), ["scope", "tag_kind", "level", "code_b"])
    ratio = [safe_ratio(F.col(f"{m}_overlap"), F.least(F.abs(f"{m}_a"), F.abs(f"{m}_b"))).alias(f"{m}_ratio") for m in measures]
    return met_both.select(*keys, "rows", *[f"{m}_{x}" for m in measures for x in ("a", "b", "overlap")], *ratio)


def net_excess(met: DataFrame, measures: list[str], has_year: bool, scale: int | None = None) -> DataFrame:
    """By group and year, what rows of k codes count k - 1 times too often; rows of a null year are left out."""
    k = F.size("codes")
    over = met.filter(k > 1) if not has_year else met.filter((k > 1) & F.col("year").isNotNull())
    return over.groupBy("scope", "tag_kind", "level", "year").agg(
        F.sum("n").alias("unique_affected_rows"), F.max(k).cast("long").alias("max_memberships"),
        *[x for m in measures for x in (exact_sum(F.col(f"m_{m}"), scale).alias(f"{m}_exposure"), exact_sum(F.col(f"m_{m}") * (k - 1), scale).alias(f"{m}_net_excess"))],
    )


def self_doubles(df: DataFrame, rules: list[Rule], measures: list[str], scale: int | None = None) -> DataFrame:
    """Rows that several branches of one rule meet, all rules in one scan."""
    several = [(i, r) for i, r in enumerate(rules) if len(r.branches) > 1]
    schema = "rule int, code string, rows long, max_branch_memberships long, " + ", ".join(f"{m}_exposure double, {m}_net_excess double" for m in measures)
    if not several:
        return df.sparkSession.createDataFrame([], schema)
    counted = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(r.code).alias("code"), reduce(add, [b.cast("int") for b in r.branches]).alias("k")) for i, r in several])
    work = df.select(counted.alias("g"), *_numbers(df, measures)).select(F.explode("g").alias("g"), *[f"m_{m}" for m in measures]).select("g.*", *[f"m_{m}" for m in measures])
    return work.filter("k > 1").groupBy("rule", "code").agg(
        F.count("*").alias("rows"), F.max("k").cast("long").alias("max_branch_memberships"),
        *[x for m in measures for x in (exact_sum(F.col(f"m_{m}"), scale).alias(f"{m}_exposure"), exact_sum(F.col(f"m_{m}") * (F.col("k") - 1), scale).alias(f"{m}_net_excess"))],
    )


def select_rules(rules: list[dict], stage: str, config: dict, codes: set[str]) -> list[dict]:
    """Tag rules of the stage whose measure is dispatched here and whose code the dictionary has."""
    return [
        r for r in rules
        if (r.get("row_type") or "TAG") == "TAG" and (r.get("sheet") or stage).casefold() == stage.casefold() and dispatched(r.get("measure"), config) and r.get("code") in codes
    ]


def check_config(config: dict) -> list[str]:
    stages = config.get("expected_stages")
    if not isinstance(stages, list) or not stages or not all(isinstance(s, str) and s.strip() for s in stages):
        raise ValueError("config requires a non-empty expected_stages list")
    if len({s.casefold() for s in stages}) != len(stages):
        raise ValueError("expected_stages repeats a stage")
    if not isinstance(config.get("expected_codes_by_stage"), dict):
        raise ValueError("config requires expected_codes_by_stage")
    if int(config.get("minimum_rules_per_stage", 1)) < 1:
        raise ValueError("minimum_rules_per_stage must be at least 1")
    return stages


def audit_overlaps(config: dict, rules: list[dict], dictionary: list[dict], inputs: dict[str, DataFrame], scale: int | None = None) -> Report:
    """C02.  inputs: a DataFrame for each range of the config.  A range and stage reads its input three times: for the rows
    that each rule matches, for the sums by set of codes (kept, and released at the end), and for doubles within a rule.

    Pairwise amounts are not to be added up; net excess is the total.  It is reported but blocks nothing by itself.
    """
    stages = check_config(config)
    least = int(config.get("minimum_rules_per_stage", 1))
    listed = [r["code"] for r in dictionary if r.get("code")]
    known = {r["code"]: r for r in dictionary if r.get("code")}
    groups = candidate_groups(list(known.values()), tuple(config.get("subnational_code_patterns", SUBNATIONAL)))
    issues, pairs, excess, doubles, coverage, ranges, tables = [], [], [], [], [], [], {}
    if repeated := sorted({c for c in listed if listed.count(c) > 1}):
        issues.append(f"code dictionary repeats codes: {repeated}")
    for stage in stages:
        expected = config["expected_codes_by_stage"].get(stage)
        if not isinstance(expected, list) or not expected:
            issues.append(f"stage {stage} requires expected codes")
            expected = []
        if repeated := sorted({c for c in expected if expected.count(c) > 1}):
            issues.append(f"stage {stage} repeats expected codes: {repeated}")
        for rng in config["ranges"]:
            df, name, measures, fields = inputs[rng["name"]], rng["name"], rng["measures"], rng["field_map"]
            if missing := sorted(set(measures) - set(df.columns)):
                raise ValueError(f"range {name} is missing measure columns {missing}")
            chosen = select_rules(rules, stage, rng, set(known))
            codes = sorted({r["code"] for r in chosen})
            lacking, extra = sorted(set(expected) - set(codes)), sorted(set(codes) - set(expected))
            if len(chosen) < least:
                issues.append(f"stage {stage} range {name} has {len(chosen)} rules, {least} are expected")
            if lacking:
                issues.append(f"stage {stage} range {name} lacks expected codes: {lacking}")
            if extra:
                issues.append(f"stage {stage} range {name} has codes outside the contract: {extra}")
            compiled = [compile_rule(df, r, fields) for r in chosen]
            usable = [r for r in compiled if r.error is None]
            matched = df.agg(F.lit(0).alias("none"), *[F.count_if(r.mask).alias(f"r{i}") for i, r in enumerate(usable)]).first() if usable else {}
            for r in compiled:
                entry = {"code": r.code, "status": r.status, "range": name}
                entry |= {"reason": r.error} if r.error else {"stage": stage, "supported_branches": len(r.branches), "unsupported_branches": r.issues, "matched_rows": matched[f"r{usable.index(r)}"]}
                coverage.append(entry)
            masks = masks_by_code(usable)
            year = fields.get("year")
            has_year = bool(year) and year in df.columns
            met = memberships(df, masks, groups, measures, year if has_year else None, scale).persist()  # a few rows, read four times
            of = {"range": name, "stage": stage}
            value = {(g, c): v for g, members in groups.items() for c, v in members.items()}
            samples = {}
            for r in usable:
                samples.setdefault(r.code, r.source)  # W03: the first rule of a code speaks for it
            made = {"pairs": pair_overlaps(met, measures, False, scale), "pairs_by_year": pair_overlaps(met, measures, True, scale), "net_excess": net_excess(met, measures, has_year, scale), "self_doubles": self_doubles(df, usable, measures, scale)}
            tables |= {f"{stage}/{name}/{k}": t for k, t in made.items()}
            by_year: dict[tuple, list] = {}
            rows_by_year = made["pairs_by_year"].orderBy("scope", "tag_kind", "level", "code_a", "code_b", F.col("year").asc_nulls_last()).collect() if has_year else []
            for r in rows_by_year:
                by_year.setdefault(tuple(r[:5]), []).append({"year": r["year"], "rows": r["rows"], "measures": {m: r[f"{m}_overlap"] for m in measures}})
            mine = []
            for r in made["pairs"].orderBy("scope", "tag_kind", "level", "code_a", "code_b").collect():
                g, a, b = (r["scope"], r["tag_kind"], r["level"]), r["code_a"], r["code_b"]
                va, vb = value[g, a], value[g, b]
                mine.append(of | dict(zip(("scope", "tag_kind", "level"), g)) | {
                    "code_a": a, "code_b": b, "value_a": va, "value_b": vb, "relationship": "same_value_duplicate" if va == vb else "cross_category", "rows": r["rows"],
                    "totals": {m: {"code_a": r[f"{m}_a"], "code_b": r[f"{m}_b"], "overlap": r[f"{m}_overlap"], "overlap_ratio_to_smaller": r[f"{m}_ratio"]} for m in measures},
                    "by_year": by_year.get(tuple(r[:5]), []), "formula_a": samples.get(a, {}).get("sample_formula"), "formula_b": samples.get(b, {}).get("sample_formula"),
                    "category_a": samples.get(a, {}).get("category"), "category_b": samples.get(b, {}).get("category"),
                })
            over = [of | r.asDict() for r in made["net_excess"].orderBy("scope", "tag_kind", "level", "year").collect()]
            twice = [of | {k: v for k, v in r.asDict().items() if k != "rule"} | {"formula_cell": usable[r["rule"]].source.get("formula_cell"), "sample_formula": usable[r["rule"]].source.get("sample_formula")} for r in made["self_doubles"].orderBy("rule").collect()]
            pairs, excess, doubles = pairs + mine, excess + over, doubles + twice
            ranges.append(of | {"selected_rules": len(chosen), "expected_codes": expected, "selected_codes": codes, "missing_expected_codes": lacking, "unexpected_codes": extra, "codes_with_masks": len(masks), "overlap_pairs": len(mine), "within_formula_self_doubles": len(twice), "net_excess_groups": len(over)})
            met.unpersist()
    unresolved = [c for c in coverage if c["status"] != "SUPPORTED"]
    blockers = issues + [f"{len(x)} {what}" for x, what in ((pairs, "overlapping pair(s)"), (doubles, "double(s) within a rule"), (unresolved, "rule(s) not fully supported")) if x]
    facts = {
        "country": config.get("country"), "expected_stages": stages, "range_summaries": ranges, "pairwise_overlaps": pairs, "dimension_year_net_excess": excess, "within_formula_self_doubles": doubles,
        "parser_coverage": coverage, "unresolved_parser_coverage": unresolved, "coverage_issues": issues, "method_note": "Pairwise amounts overlap each other: net excess is the total, their sum is not.",
    }
    return Report("overcounting", blockers, encode(facts), tables)


def first_rules(rules: DataFrame, code: str, order: str, columns: list[str]) -> DataFrame:
    """W03 over a table: of each code the columns of its first rule, by one grouping."""
    first = F.min_by(F.struct(*columns), order).alias("_first")
    return rules.groupBy(code).agg(first).select(code, *[F.col(f"_first.{c}").alias(c) for c in columns])


def pair_detail(df: DataFrame, measures: list[str]) -> DataFrame:
    """One row a pair and year."""
    return df.select("scope", "tag_kind", "level", "code_a", "code_b", "year", "rows", *[f"{m}_overlap" for m in measures])
