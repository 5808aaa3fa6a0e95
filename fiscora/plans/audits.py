"""Queries of the catalogue that run whole audits, files and workbooks, each with the SQL that gives the same rows.

Audits return their blockers as rows.  Workbooks and files are made from the test tables, written to the shared folder and
read back by the sources, so that the SQL over the same tables tells what they must say.
"""

from __future__ import annotations

import io
import json
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import is_blank, is_empty, normalize_formula, number_text, timestamp_ok
from ..operators import coverage, duplicates, flags, lineage, marts, overlap, reconcile, workbook
from ..report import Report
from ..sources import ooxml, tables
from ..sources.shared import shared_folder, write_file
from .catalogue import _FLAGGED, _URGENT, _COVERED, _covered, _flagged, query, read


def said(spark: SparkSession, lines: list[str]) -> DataFrame:
    return spark.createDataFrame([(x,) for x in lines], "blocker string")


def _counted(*parts: tuple[str, str]) -> str:
    """SQL of blockers: (count, text with {n} or without), each where the count is above zero."""
    return " union all ".join("select replace('{}', '{{n}}', cast(({}) as varchar)) as blocker where ({}) > 0".format(text.replace("'", "''"), n, n) for n, text in parts)


# ---- whole audits ----------------------------------------------------------------------------------------------

_AMOUNT = "case when o_orderkey % 40 = 0 then null when o_orderkey % 40 = 1 then 'x' else cast(o_totalprice as {}) end"
_DERIVED = "(o_orderpriority like '1-%' or o_orderpriority = '2-HIGH')"


def _flag_audit(spark: SparkSession, sf_dir: str) -> Report:
    rows = _flagged(spark, sf_dir).withColumn("amount", F.expr(_AMOUNT.format("string")))
    return flags.audit_flags(rows, ["amount"], ["o_orderkey"], _URGENT, flag_column="raw", tolerance=1e18, scale=2)


@query(
    _FLAGGED + ", a as (select *, " + _AMOUNT.format("varchar") + f" as amount, {_DERIVED} as derived from s) "
    + _counted(
        ("select count(*) from a where status = 'invalid'", "{n} row(s) have an invalid output flag"), ("select count(*) from a where status = 'null'", "{n} row(s) have a null output flag"),
        ("select coalesce(sum(n), 0) from (select count(*) as n from a group by o_orderkey having count(*) > 1)", "{n} row(s) have a duplicate stable id"),
        ("select count(*) from a where flag is not null and flag <> derived", "{n} row(s) disagree with the derived flag"), ("select count(*) from a where amount = 'x'", "{n} row(s) have a non-numeric amount"),
        ("select count(*) from a where amount is null", "{n} row(s) have a null amount"),
    )
    + " union all select 'year ' || year || ' has ' || (count(*) - count(flag)) || ' unpartitioned row(s)' from a group by year having count(*) > count(flag)"
)
def flag_audit_blockers(spark, sf_dir):
    return said(spark, _flag_audit(spark, sf_dir).blockers)


@query(_FLAGGED + ", a as (select " + _AMOUNT.format("varchar") + " as amount from s) select 'amount' as measure, count(*) filter (where amount is null) as null_rows, count(*) filter (where amount = 'x') as invalid_rows from a")
def flag_measure_quality(spark, sf_dir):
    quality = _flag_audit(spark, sf_dir).facts["measure_quality"]
    return spark.createDataFrame([(m, q["null_rows"], q["invalid_rows"]) for m, q in quality.items()], "measure string, null_rows long, invalid_rows long")


@query(
    _FLAGGED + f"""select o_orderkey, raw as output_flag_raw, status as output_flag_status, flag as output_flag_normalized, 'valid' as expected_flag_status, {_DERIVED} as expected_flag_normalized,
    coalesce(flag <> {_DERIVED}, false) as flag_mismatch from s"""
)
def flag_detail_file(spark, sf_dir):
    """The detail table as it is written."""
    path = shared_folder(spark, "flag-detail")
    _flag_audit(spark, sf_dir).write_table("detail", path)
    kinds = "o_orderkey long, output_flag_raw string, output_flag_status string, output_flag_normalized boolean, expected_flag_status string, expected_flag_normalized boolean, flag_mismatch boolean"
    return spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).schema(kinds).csv(path)


_RULES = [("A", [{"field": "flag", "value": "A"}]), ("F", [{"field": "status", "value": "F"}]), ("A", [{"field": "flag", "value": "a"}, {"field": "quantity", "op": ">", "value": 40}]), ("F", [{"field": "nowhere", "value": "x"}]), ("Z", [{"field": "flag", "value": "R"}])]


def _overlap_audit(spark: SparkSession, sf_dir: str) -> Report:
    rows = read(spark, sf_dir, "lineitem").selectExpr("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice as amount", "cast(year(l_shipdate) as string) as y")
    rules = [{"code": c, "row_type": "TAG", "sheet": "Approved", "measure": "amount", "criteria_json": json.dumps(k), "sample_formula": "=1", "formula_cell": f"A{i}"} for i, (c, k) in enumerate(_RULES)]
    codes = [{"code": c, "tag_kind": "primary", "econ": c, "econ_sub": "", "func": "", "func_sub": ""} for c in ("A", "F")]
    fields = {"flag": "l_returnflag", "status": "l_linestatus", "quantity": "l_quantity", "year": "y"}
    config = {"country": "X", "expected_stages": ["Approved"], "expected_codes_by_stage": {"Approved": ["A", "F", "G"]}, "ranges": [{"name": "lines", "measures": ["amount"], "measure_dispatch": ["amount"], "field_map": fields}]}
    return overlap.audit_overlaps(config, rules, codes, {"lines": rows}, scale=2)


@query(
    "select 'stage Approved range lines lacks expected codes: [''G'']' as blocker union all select '1 overlapping pair(s)' where (select count(*) from lineitem where l_returnflag = 'A' and l_linestatus = 'F') > 0 "
    "union all select '1 rule(s) not fully supported'"
)
def overlap_audit_blockers(spark, sf_dir):
    return said(spark, _overlap_audit(spark, sf_dir).blockers)


@query(
    """select 'A' as code, 'SUPPORTED' as status, count(*) as matched_rows from lineitem where l_returnflag = 'A' union all select 'F', 'SUPPORTED', count(*) from lineitem where l_linestatus = 'F'
    union all select 'A', 'SUPPORTED', count(*) from lineitem where l_returnflag = 'A' and l_quantity > 40 union all select 'F', 'PARTIAL', 0"""
)
def overlap_rule_coverage(spark, sf_dir):
    """Rules of codes that the dictionary lacks are no part of it."""
    found = _overlap_audit(spark, sf_dir).facts["parser_coverage"]
    return spark.createDataFrame([(c["code"], c["status"], c["matched_rows"]) for c in found], "code string, status string, matched_rows long")


@query("select p_brand as code, arg_min(p_name, p_partkey) as p_name, arg_min(p_type, p_partkey) as p_type from part group by 1")
def overlap_first_rules(spark, sf_dir):
    rules = read(spark, sf_dir, "part").withColumnRenamed("p_brand", "code")
    return overlap.first_rules(rules, "code", "p_partkey", ["p_name", "p_type"])


@query(
    """with l as (select l_orderkey as k, sum(l_quantity) as v, count(*) as n, count(*) filter (where l_linenumber = 7) as gone from lineitem group by 1), r as (select o_orderkey as k, cast(10 * (o_orderkey % 9) as double) as v, count(*) as n from orders group by 1, 2),
    j as (select l.k as a, r.k as b, l.v - r.v as d, r.v as base from l full outer join r on l.k = r.k) """
    + _counted(
        ("select count(*) from j where a is not null and b is not null and not (abs(d) <= 0.5) and not coalesce(abs(d) / nullif(abs(base), 0) <= 0.05, false)", "{n} DISCREPANCY row(s)"),
        ("select count(*) from j where a is null", "{n} MISSING_LEFT row(s)"), ("select count(*) from j where b is null", "{n} MISSING_RIGHT row(s)"), ("select coalesce(sum(n), 0) from l where n > 1", "left has {n} duplicate key rows"),
        ("select coalesce(sum(n), 0) from r where n > 1", "right has {n} duplicate key rows"),
    )
)
def reconcile_audit_blockers(spark, sf_dir):
    left = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey as k", "l_quantity as v")
    right = read(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "cast(10 * (o_orderkey % 9) as double) as v")
    return said(spark, reconcile.reconcile(left, right, ["k"], "v", "v", scale=2).blockers)


_GAPS = {"required_years": [1996, 1998, 2001, 2050], "year_column": "y", "value_column": "v"}
_FOUND = (
    _COVERED
    + """, a as (select 'NOWHERE' as unit union all select 'MARS'), labels as (select unnest(['nobody']) as source, unnest(['VENUS']) as target),
    f as (select 'blank_name' as rule, null as subject, null::int as year, count(*) as n from w where source_name = ''
    union all select 'stray_name', target_name, null, 1 from w where target_name <> '' and target_name not in (select unit from units) group by target_name
    union all select 'no_data', unit, null, 1 from units where unit not in (select target_name from w) and unit not in (select unit from a)
    union all select 'stray_gap', unit, null, 1 from a where unit not in (select unit from units)
    union all select 'stray_target', target, null, 1 from labels where target not in (select unit from units)
    union all select 'unused_label', source, null, 1 from labels where source not in (select source_name from w)
    union all select 'null_value', null, null, count(*) filter (where v is null) from w union all select 'text_value', null, null, count(*) filter (where v = 'x') from w union all select 'negative_value', null, null, count(*) filter (where v = '-1') from w
    union all select 'repeated_key', null, null, coalesce(sum(n), 0) from (select count(*) as n from w group by target_name, y having count(*) > 1)
    union all select 'merged_target', target_name, null, count(distinct source_name) from w where target_name <> '' group by target_name having count(distinct source_name) > 1
    union all select 'bad_year', null, null, count(*) from w where y is null
    union all select 'year_gap', unit, yy, 1 from units cross join (select unnest([1996, 1998, 2001, 2050])::int as yy) where unit not in (select unit from a) and not exists (select 1 from w where target_name = unit and y = yy))
    """
)


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, units = _covered(spark, sf_dir)
    accepted, labels = spark.createDataFrame([("NOWHERE",), ("MARS",)], "unit string"), spark.createDataFrame([("nobody", "VENUS")], "source string, target string")
    return coverage.findings(coverage.cells(work, "y", "v"), units, _GAPS, accepted, labels)


@query(_FOUND + "select rule, subject, year, cast(n as bigint) as n from f where n > 0")
def coverage_findings(spark, sf_dir):
    return _found(spark, sf_dir)


@query(_FOUND + "select rule, cast(case when rule in ('blank_name', 'null_value', 'text_value', 'negative_value', 'repeated_key', 'bad_year') then sum(n) else count(*) end as bigint) as n from f where n > 0 group by 1")
def coverage_audit_counts(spark, sf_dir):
    """What the audit's report says of its findings."""
    return spark.createDataFrame([(rule, x["count"]) for rule, x in coverage.told(_found(spark, sf_dir), 2).items()], "rule string, n long")


@query(_COVERED + "select (select count(distinct source_name) from w where source_name <> '') as source_units, (select count(*) from units where unit in (select target_name from w)) as target_units")
def coverage_unit_counts(spark, sf_dir):
    return coverage.unit_counts(*_covered(spark, sf_dir))


_SHAPE = """case when s_suppkey % 6 = 0 then null when s_suppkey % 6 = 1 then '{"type":"Polygon","coordinates":[[[0,0],[4,4],[4,0],[0,4],[0,0]]]}' when s_suppkey % 6 = 2 then '{"type":"Point","coordinates":[0,0]}'
  when s_suppkey % 6 = 3 then '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,0]]]}' when s_suppkey % 6 = 4 then '{"type":"Blob","coordinates":[1]}' else '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4]]]}' end"""
_BOUNDS = "select case when s_suppkey % 10 = 0 then ' ' else n_name end as name, " + _SHAPE + " as geometry from supplier join nation on s_nationkey = n_nationkey"


@query(
    f"""with b as ({_BOUNDS.replace("s_suppkey", "s_suppkey")}), s as (select s_suppkey from supplier) select case when trim(name) = '' then 'blank name' else 'repeated name' end as problem, trim(name) as subject, count(*) as n from b group by 1, 2 having count(*) > 1 or trim(name) = ''
    union all select 'missing geometry', '', count(*) from s where s_suppkey % 6 = 0 having count(*) > 0 union all select 'invalid geometry', '', count(*) from s where s_suppkey % 6 in (1, 4, 5) having count(*) > 0"""
)
def boundary_problems(spark, sf_dir):
    """G13, X01, X02."""
    joined = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return coverage.boundary_problems(joined.select(F.expr("case when s_suppkey % 10 = 0 then ' ' else n_name end").alias("name"), F.expr(_SHAPE).alias("geometry")), True)


_PEOPLE = "select n_name as region, cast(year(o_orderdate) as int) as y, case when n_nationkey = 3 then null when n_nationkey = 4 then -1 else cast(count(*) as double) end as people from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name, n_nationkey, year(o_orderdate)"


@query(
    f"with p as ({_PEOPLE}) "
    + _counted(
        ("select count(*) from p where people is null", "{n} rows of null population"), ("select count(*) from p where people <= 0", "{n} rows of no positive population"),
        ("select count(*) from (select 1 where 1990 not in (select y from p))", "year 1990 is missing"),
    )
    + " union all select 'year ' || yy || ' has ' || (select count(distinct region) from p where y = yy) || ' units, not 26' from (select unnest([1996, 1997]) as yy) union all select 'year 1996 does not add up to its published total'"
)
def population_problems(spark, sf_dir):
    o, c, n = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    counts = joined.groupBy("n_name", "n_nationkey", F.year("o_orderdate").alias("y")).agg(F.count("*").cast("double").alias("n"))
    people = counts.select(F.col("n_name").alias("region"), "y", F.expr("case when n_nationkey = 3 then null when n_nationkey = 4 then -1 else n end").alias("people"))
    return said(spark, marts.population_problems(people, "region", "y", "people", [1990, 1996, 1997], 26, {1996: -5.0}))


def _countries(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    o, c, n = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_regionkey", F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("amount"))
    gold = {f"R{k}": rows.filter(F.col("n_regionkey") == k).select("year", "amount") for k in range(5)}
    return gold, marts.union_countries({k: df if k != "R2" else df.filter("year > 1997") for k, df in gold.items()})


@query("select distinct 'R2' as country, cast(year(o_orderdate) as bigint) as year from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where n_regionkey = 2 and year(o_orderdate) <= 1997")
def registry_lost_years(spark, sf_dir):
    gold, aggregate = _countries(spark, sf_dir)
    return marts.lost_years(gold, aggregate)


@query(
    """select 'country registered 2 times: R1' as blocker union all select 'aggregate lost years of R2: [' || string_agg(cast(y as varchar), ', ' order by y) || ']' from
    (select distinct year(o_orderdate) as y from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where n_regionkey = 2 and year(o_orderdate) <= 1997)"""
)
def registry_problems(spark, sf_dir):
    gold, aggregate = _countries(spark, sf_dir)
    return said(spark, marts.registry_problems(gold, aggregate, ["R0", "R1", "R1", "R2", "R3", "R4"]))


@query("select distinct cast(year(l_shipdate) as bigint) as year from lineitem")
def distinct_years(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(F.year("l_shipdate").cast("long").alias("year")).distinct()


_SOURCE = "with s as (select lower(replace(n_name, ' ', '_')) as id, lower(replace(n_name, ' ', '_')) as me, n_nationkey as k from nation)"


@query(
    _SOURCE + """ select id as subject, 'is derived and names no parent' as problem from s where k % 5 = 0 and k % 4 <> 1 and k % 4 <> 2 union all select id, 'is its own parent' from s where k % 4 = 1
    union all select id, 'has the parent n' || (k + 100) || ', which is no source' from s where k % 4 = 2 union all select id, 'is primary, but does not lead' from s where k in (0, 5) union all select 'gone', 'is primary, but no source'"""
)
def inventory_relations(spark, sf_dir):
    """C07's relations between sources, U06: what the inventory says of its sources, parents and primary sources."""
    sources = []
    for r in read(spark, sf_dir, "nation").collect():
        ident, k = r["n_name"].lower().replace(" ", "_"), r["n_nationkey"]
        parents = [ident] if k % 4 == 1 else [f"n{k + 100}"] if k % 4 == 2 else []
        sources.append({"id": ident, "kind": "fiscal_workbook", "authority": "derived" if k % 5 == 0 else "authoritative", "derived_from": parents})
    by_key = {r["n_nationkey"]: r["n_name"].lower().replace(" ", "_") for r in read(spark, sf_dir, "nation").collect()}
    return spark.createDataFrame(lineage.relation_problems(sources, [by_key[0], by_key[5], "gone"], lineage.WORKBOOK_KIND), "subject string, problem string")


# ---- rows, keys and values -------------------------------------------------------------------------------------

_ODD = "case when p_size % 10 = 0 then null when p_size % 10 = 1 then '  ' else p_type end"


@query(f"select p_partkey, {_ODD} as kind, nullif(p_size, 20) as size from part where not (trim(coalesce({_ODD}, '')) = '' and nullif(p_size, 20) is null)")
def populated_rows(spark, sf_dir):
    """Rows that are blank in both columns go."""
    return duplicates.populated(read(spark, sf_dir, "part").select("p_partkey", F.expr(_ODD).alias("kind"), F.expr("nullif(p_size, 20)").alias("size")), ["kind", "size"])


@query(
    """with t as (select p_partkey as row, unnest([1, 2, 3, 4]) as k, p_size from part), v as (select row, case k when 1 then 'number' when 2 then 'number' when 3 then 'bool' else 'text' end as kind,
    case k when 3 then cast(p_size % 2 = 0 as varchar) when 4 then cast(p_size % 10 as varchar) else cast(p_size % 10 as varchar) || '.0' end as value from t)
    select kind, value, cast(min(row) as bigint) as first_row, count(*) as n from v group by 1, 2 having count(*) > 1"""
)
def typed_keys_across_types(spark, sf_dir):
    """An integer and a double of one value are one key; a boolean and a text are others."""
    p, keys = read(spark, sf_dir, "part"), []
    for made in ("p_size % 10", "cast(p_size % 10 as double)", "p_size % 2 = 0", "cast(p_size % 10 as string)"):
        df = p.selectExpr("p_partkey as row", f"{made} as x")
        keys.append(df.select("row", duplicates.typed_keys(df, ["x"])[0].alias("key")))
    every = keys[0]
    for k in keys[1:]:
        every = every.unionByName(k)
    groups = duplicates.duplicate_groups(every, ["key"], "row")
    return groups.select(F.col("key")[0]["kind"].alias("kind"), F.col("key")[0]["value"].alias("value"), "first_row", "n")


@query("select p_brand, p_type, cast(min(p_partkey) as bigint) as first_row, count(*) as n from part group by 1, 2 having count(*) > 1 order by first_row limit 20")
def duplicate_groups_sample(spark, sf_dir):
    """Exact rows but for an ignored column, ordered by the group's first row, and cut."""
    groups = duplicates.duplicate_groups(read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"), ["p_brand", "p_type"], "p_partkey")
    return groups.select(F.col("key")[0]["value"].alias("p_brand"), F.col("key")[1]["value"].alias("p_type"), "first_row", "n").orderBy("first_row").limit(20)


@query("select p_partkey, p_brand, p_type, first_row, n from (select p_partkey, p_brand, p_type, min(p_partkey) over w as first_row, count(*) over w as n from part window w as (partition by p_brand, p_type)) where n > 1")
def duplicate_members(spark, sf_dir):
    return duplicates.duplicate_members(read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"), ["p_brand", "p_type"], "p_partkey")


_LABEL = "case when n_nationkey % 3 = 0 then ' ' || lower(n_name) || '  X' when n_nationkey % 3 = 1 then n_name || ' x' else n_name end"


@query(f"with l as (select {_LABEL} as label from nation union all select n_name || '  X' from nation) select trim(regexp_replace(lower(label), '\\s+', ' ', 'g')) as normal, count(*) as n from l group by 1 having count(*) > 1")
def header_collisions(spark, sf_dir):
    """Labels of a header that are one but for case and spaces."""
    labels = [r[0] for r in read(spark, sf_dir, "nation").select(F.expr(_LABEL)).collect()] + [r[0] for r in read(spark, sf_dir, "nation").selectExpr("n_name || '  X'").collect()]
    return spark.createDataFrame([(k, len(v)) for k, v in duplicates.header_collisions(labels).items()], "normal string, n long")


@query("select n_name as wanted, case when n_nationkey % 4 = 0 then 'not found' when n_nationkey % 4 = 1 then 'is ambiguous' else 'found' end as outcome from nation")
def resolved_columns(spark, sf_dir):
    """A header where some labels are written another way, some twice, and some not at all."""
    names = [(r["n_name"], r["n_nationkey"]) for r in read(spark, sf_dir, "nation").collect()]
    labels = [x for n, k in names for x in ([] if k % 4 == 0 else [n, f" {n.lower()} "] if k % 4 == 1 else [n.lower()])]
    found, errors = duplicates.resolve_columns([n for n, _ in names], labels, "key")
    rows = [(n, "found") for n, _ in names if n.lower() in found] + [(e.split(": ", 1)[1], "is ambiguous" if "ambiguous" in e else "not found") for e in errors]
    return spark.createDataFrame(rows, "wanted string, outcome string")


@query(f"select p_partkey, coalesce(v = '', true) as is_null, coalesce(trim(v) = '', true) as blank from (select p_partkey, case when p_size % 10 = 2 then '' else {_ODD} end as v from part)")
def dictionary_nulls(spark, sf_dir):
    """White space is no null of a dictionary, though it is blank."""
    v = read(spark, sf_dir, "part").select("p_partkey", F.expr(f"case when p_size % 10 = 2 then '' else {_ODD} end").alias("v"))
    return v.select("p_partkey", is_empty(F.col("v")).alias("is_null"), is_blank(F.col("v")).alias("blank"))


@query("select p_partkey, '=' || ltrim(repeat('=', p_size % 3) || 'SUM(A' || p_size || ')', '=') as formula from part")
def formulas_normalized(spark, sf_dir):
    """N14."""
    return read(spark, sf_dir, "part").select("p_partkey", normalize_formula(F.expr("concat(repeat('=', p_size % 3), 'SUM(A', p_size, ')')")).alias("formula"))


@query("select distinct p_size as n, cast(p_size as varchar) as said, case when p_size % 3 = 0 then true when p_size % 3 = 1 then false else true end as timed from part")
def scalars(spark, sf_dir):
    """Numbers as a workbook has them, and times with and without a zone."""
    sizes = [r[0] for r in read(spark, sf_dir, "part").select("p_size").distinct().collect()]
    stamp = lambda n: f"2024-01-01T00:00:{n % 60:02d}" + ("Z", "", "+02:00")[n % 3]
    return spark.createDataFrame([(n, number_text(float(n)), timestamp_ok(stamp(n))) for n in sizes], "n int, said string, timed boolean")


# ---- files -----------------------------------------------------------------------------------------------------

_PARTS = "p_partkey, p_name, p_brand, p_size"


def _written(spark: SparkSession, sf_dir: str, kind: str) -> str:
    path = f"{shared_folder(spark, 'parts')}.{kind}"
    rows = read(spark, sf_dir, "part").selectExpr("p_partkey", "p_name", "p_brand", "p_size", "case when p_size % 4 = 0 then 'NA' when p_size % 4 = 1 then lpad(cast(p_size as string), 5, '0') else p_type end as note")
    {"csv": lambda w: w.option("header", True).csv(path), "json": lambda w: w.json(path), "parquet": lambda w: w.parquet(path)}[kind](rows.write)
    return path


_NOTE = "case when p_size % 4 = 0 then {} when p_size % 4 = 1 then lpad(cast(p_size as varchar), 5, '0') else p_type end as note"


@query(f"select {_PARTS}, {_NOTE.format('null')} from part")
def csv_scan(spark, sf_dir):
    """Null markers of a CSV are nulls, and codes keep their zeros."""
    found = tables.read_table(spark, _written(spark, sf_dir, "csv"), text_columns=("note",))
    return found.selectExpr("cast(p_partkey as long) as p_partkey", "p_name", "p_brand", "p_size", "note")


@query(f"select {_PARTS}, {_NOTE.format(chr(39) + 'NA' + chr(39))} from part")
def parquet_scan(spark, sf_dir):
    return tables.read_table(spark, _written(spark, sf_dir, "parquet"))


@query("select cast(p_partkey as varchar) as p_partkey, p_name, p_brand, cast(p_size as varchar) as p_size, " + _NOTE.format("'NA'") + " from part")
def record_scan(spark, sf_dir):
    """Everything as text."""
    return tables.read_records(spark, _written(spark, sf_dir, "csv"))


@query("select trim(case when s_suppkey % 10 = 0 then null else n_name end) is null as unnamed, count(*) as n from supplier join nation on s_nationkey = n_nationkey group by 1")
def geojson_scan(spark, sf_dir):
    """A feature without the property has an empty name."""
    rows = read(spark, sf_dir, "supplier").join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name").collect()
    features = [{"type": "Feature", "properties": {} if r["s_suppkey"] % 10 == 0 else {"n": f" {r['n_name']} "}, "geometry": {"type": "Point", "coordinates": [0, 0]}} for r in rows]
    path = write_file(shared_folder(spark, "bounds") + ".geojson", json.dumps({"type": "FeatureCollection", "features": features}).encode())
    bounds, _ = tables.read_boundaries(spark, path, "n")
    return bounds.groupBy((F.col("name") == "").alias("unnamed")).agg(F.count("*").alias("n"))


@query("select n_name as name, sha256(n_name || chr(10)) as sha256, cast(octet_length(encode(n_name)) + 1 as bigint) as bytes from nation")
def file_digests(spark, sf_dir):
    """A file for each nation, hashed by the executors."""
    root = shared_folder(spark, "files")
    names = {r["n_name"]: f"f{r['n_nationkey']}" for r in read(spark, sf_dir, "nation").collect()}
    for name, file in names.items():
        write_file(f"{root}/{file}", f"{name}\n".encode())
    known = spark.createDataFrame(list(names.items()), "name string, file string")
    found = lineage.file_digests(spark, root).withColumn("file", F.element_at(F.split("path", "/"), -1))
    return found.join(known, "file").select("name", "sha256", "bytes")


# ---- workbooks -------------------------------------------------------------------------------------------------


def _cell(ref: str, value: object = None, formula: str | None = None, kind: str | None = None, style: int | None = None) -> str:
    marks = "".join(f' {k}="{v}"' for k, v in (("t", kind), ("s", style)) if v is not None)
    if kind == "inlineStr":
        return f'<c r="{ref}"{marks}><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'
    return f'<c r="{ref}"{marks}>' + (f"<f>{escape(formula)}</f>" if formula is not None else "") + (f"<v>{escape(str(value))}</v>" if value is not None else "") + "</c>"


_STYLES = f'<styleSheet xmlns="{ooxml.MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'


def _pack(sheets: dict[str, str], names: str = "") -> bytes:
    """A workbook of sheets (name to rows of cells); the second is hidden."""
    listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"' + (' state="hidden"' if i == 2 else "") + "/>" for i, n in enumerate(sheets, 1))
    rels = "".join(f'<Relationship Id="rId{i}" Type="x/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(ooxml.WORKBOOK, f'<workbook xmlns="{ooxml.MAIN}" xmlns:r="{ooxml.DOC_REL}"><sheets>{listed}</sheets>{names}<calcPr calcId="7"/></workbook>')
        z.writestr(ooxml.RELS, f'<Relationships xmlns="{ooxml.PKG_REL}">{rels}</Relationships>')
        z.writestr(ooxml.STYLES, _STYLES)
        for i, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{ooxml.MAIN}"><sheetData>{rows}</sheetData></worksheet>')
    return held.getvalue()


def _nation_rows(spark: SparkSession, sf_dir: str) -> list[tuple[int, str, int]]:
    return [tuple(r) for r in read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_nationkey").collect()]


def _book(spark: SparkSession, sf_dir: str) -> str:
    """Sheet Nations: id (a number; a text where the key is 7 by 7), name, region, double (a formula; no cache where the key
    is 5 by 5), check (an error where it is 6 by 6, else a boolean), day (a date); sheet Calc: formulas and constants."""
    rows = ['<row r="1">' + "".join(_cell(f"{c}1", label, kind="inlineStr") for c, label in zip("ABCDEF", ("id", "name", "region", "double", "check", "day"))) + "</row>"]
    calc = []
    for k, name, region in _nation_rows(spark, sf_dir):
        r = k + 2
        ident = _cell(f"A{r}", k % 20, kind="inlineStr") if k % 7 == 0 else _cell(f"A{r}", k % 20 if k % 2 else f"{k % 20}.0")
        check = _cell(f"E{r}", "#N/A", kind="e") if k % 6 == 0 else _cell(f"E{r}", k % 2, kind="b")
        rows.append(f'<row r="{r}">' + ident + _cell(f"B{r}", name, kind="inlineStr") + _cell(f"C{r}", region) + _cell(f"D{r}", None if k % 5 == 0 else 2 * region, f"C{r}*2") + check + _cell(f"F{r}", 45292 + k, style=1) + "</row>")
        calc.append(f'<row r="{k + 1}">' + _cell(f"A{k + 1}", k, f"SUM(Nations!C2:C{r})+SUM(1,2)") + _cell(f"B{k + 1}", k, f"OFFSET(A1,{k},0)" if k % 4 == 0 else f"A{k + 1}+1") + _cell(f"C{k + 1}", k) + "</row>")
    names = '<definedNames><definedName name="ok">Nations!$A$1</definedName><definedName name="gone" hidden="1">#REF!</definedName></definedNames>'
    uri = write_file(shared_folder(spark, "books") + "/book.xlsx", _pack({"Nations": "".join(rows), "Calc": "".join(calc)}, names))
    return uri.removeprefix("file://")


@query(
    """with n as (select *, n_nationkey as k, n_nationkey + 2 as r from nation), c as (
    select 'Nations' as sheet, 'A1' as ref, 'id' as value, 'text' as kind, false as has_formula union all select 'Nations', 'B1', 'name', 'text', false union all select 'Nations', 'C1', 'region', 'text', false
    union all select 'Nations', 'D1', 'double', 'text', false union all select 'Nations', 'E1', 'check', 'text', false union all select 'Nations', 'F1', 'day', 'text', false
    union all select 'Nations', 'A' || r, case when k % 7 = 0 or k % 2 = 1 then cast(k % 20 as varchar) else (k % 20) || '.0' end, case when k % 7 = 0 then 'text' else 'number' end, false from n
    union all select 'Nations', 'B' || r, n_name, 'text', false from n union all select 'Nations', 'C' || r, cast(n_regionkey as varchar), 'number', false from n
    union all select 'Nations', 'D' || r, case when k % 5 = 0 then null else cast(2 * n_regionkey as varchar) end, 'text', true from n
    union all select 'Nations', 'E' || r, case when k % 6 = 0 then '#N/A' when k % 2 = 1 then 'true' else 'false' end, case when k % 6 = 0 then 'text' else 'bool' end, false from n
    union all select 'Nations', 'F' || r, strftime(date '2024-01-01' + cast(k as int), '%Y-%m-%d') || 'T00:00:00', 'date', false from n
    union all select 'Calc', 'A' || (k + 1), cast(k as varchar), 'text', true from n union all select 'Calc', 'B' || (k + 1), cast(k as varchar), 'text', true from n union all select 'Calc', 'C' || (k + 1), cast(k as varchar), 'number', false from n)
    select * from c"""
)
def workbook_cells(spark, sf_dir):
    """Cells of a real workbook, with their kinds."""
    return ooxml.read_cells(spark, _book(spark, sf_dir)).select("sheet", "ref", "value", "kind", "has_formula")


@query(
    """select 'Nations' as sheet, 'visible' as state, 6 + 6 * count(*) as cell_count, count(*) as formula_count, cast(1 as int) as min_row, cast(max(n_nationkey) + 2 as int) as max_row, cast(1 as int) as min_col, cast(6 as int) as max_col,
    count(*) filter (where n_nationkey % 5 = 0) as without_cache, count(*) filter (where n_nationkey % 6 = 0) as errors from nation
    union all select 'Calc', 'hidden', 3 * count(*), 2 * count(*), 1, cast(max(n_nationkey) + 1 as int), 1, 3, 0, 0 from nation"""
)
def workbook_sheets(spark, sf_dir):
    """G16."""
    return workbook.sheet_summary(ooxml.read_cells(spark, _book(spark, sf_dir))).drop("sheet_pos")


@query(
    """select sheet, cast(volatile as bigint) as volatile_formula_count, cast(hard as bigint) as hardcoded_suspect_count from (select 'Nations' as sheet, 0 as volatile, (select count(*) from nation where n_nationkey < 0) as hard
    union all select 'Calc', (select count(*) from nation where n_nationkey % 4 = 0), (select count(*) from nation))"""
)
def workbook_sheet_table(spark, sf_dir):
    """Constants beside two formulas of a row are suspects."""
    path = _book(spark, sf_dir)
    return workbook.sheet_table(workbook.audit_workbook(spark, path).tables).select("sheet", "volatile_formula_count", "hardcoded_suspect_count")


@query("select 'Nations' as sheet, 'E' || (n_nationkey + 2) as ref, '#N/A' as value, false as has_formula from nation where n_nationkey % 6 = 0")
def workbook_error_cells(spark, sf_dir):
    """P11."""
    return workbook.error_cells(ooxml.read_cells(spark, _book(spark, sf_dir)))


@query(
    """select (select count(*) from nation where n_nationkey % 5 = 0) || ' formula cell(s) have no cached value' as blocker union all select (select count(*) from nation where n_nationkey % 6 = 0) || ' cell(s) hold errors'"""
)
def workbook_audit_blockers(spark, sf_dir):
    """C06, G17."""
    return said(spark, workbook.audit_workbook(spark, _book(spark, sf_dir)).blockers)


@query("select 'Calc' as sheet, 'OFFSET' as function, count(*) filter (where n_nationkey % 4 = 0) as n from nation union all select 'Calc', 'SUM', 2 * count(*) from nation")
def workbook_functions(spark, sf_dir):
    return workbook.functions_used(ooxml.read_cells(spark, _book(spark, sf_dir)))


@query("select 'gone' as name, true as broken, true as hidden, '#REF!' as refers_to union all select 'ok', false, false, 'Nations!$A$1'")
def workbook_names(spark, sf_dir):
    """S13."""
    found = ooxml.defined_names(_book(spark, sf_dir))
    return spark.createDataFrame([(n["name"], n["broken"], n["hidden"], n["refers_to"]) for n in found], "name string, broken boolean, hidden boolean, refers_to string")


_IDS = "select case when n_nationkey % 7 = 0 then 'text' else 'number' end as kind, case when n_nationkey % 7 = 0 then cast(n_nationkey % 20 as varchar) else (n_nationkey % 20) || '.0' end as id, n_nationkey as k from nation"


@query(f"with i as ({_IDS}) select kind, id, cast(min(k) + 2 as bigint) as first_row, count(*) as n from i group by 1, 2 having count(*) > 1")
def workbook_repeated_keys(spark, sf_dir):
    """Business keys of a real sheet, where a number and a text are two keys, and 1 and 1.0 are one."""
    rows, _ = ooxml.read_sheet(spark, _book(spark, sf_dir), "Nations", typed=True)
    groups = duplicates.duplicate_groups(rows, ["id"], "row_number")
    return groups.select(F.col("key")[0]["kind"].alias("kind"), F.col("key")[0]["value"].alias("id"), F.col("first_row").cast("long").alias("first_row"), "n")


_REVIEW = {"reason": "known", "owner": "o", "evidence": "e", "checked_at": "2026-01-01T00:00:00Z"}


@query(
    f"""with i as ({_IDS}), g as (select kind, id from i group by 1, 2 having count(*) > 1 and not (kind = 'number' and id = '1.0'))
    select 'Nations: ' || (select count(*) from g) || ' unexpected duplicate business-key group(s)' as blocker union all select 'workbook sheets missing from the audit contract: Calc'"""
)
def duplicate_audit_blockers(spark, sf_dir):
    """C05 with a reviewed exception whose value is a number."""
    path = _book(spark, sf_dir)
    sheet = {"name": "Nations", "role": "raw", "check_duplicate_headers": True, "check_exact_rows": True, "key_columns": ["ID"], "allowed_duplicate_keys": [{"values": [1], **_REVIEW}]}

    def rows_of(name: str, config: dict) -> tuple[DataFrame, str, list[str]]:
        rows, labels = ooxml.read_sheet(spark, path, name, typed=True)
        return rows, "row_number", labels

    return said(spark, duplicates.audit_workbook_duplicates(ooxml.sheet_names(path), {"check_normalized_sheet_names": True, "sheets": [sheet]}, rows_of).blockers)


def _patched(spark: SparkSession, sf_dir: str) -> tuple[str, str, list[dict]]:
    base = _book(spark, sf_dir)
    keys = [k for k, _, _ in _nation_rows(spark, sf_dir) if k % 3 == 0]
    patches = [{"sheet": "Nations", "cell": f"D{k + 2}", "old_formula": f"=C{k + 2}*2", "new_formula": f"C{k + 2}*3", "expected_after": k, "reason": "r"} for k in keys]
    output = shared_folder(spark, "books").removeprefix("file://") + ".xlsx"
    workbook.patch_workbook(base, patches, output)
    return base, output, patches


@query("select 'Nations' as sheet, 'D' || (n_nationkey + 2) as ref from nation where n_nationkey % 3 = 0")
def workbook_differences(spark, sf_dir):
    """Cells that differ after a patch."""
    base, output, _ = _patched(spark, sf_dir)
    return workbook.cell_differences(ooxml.read_cells(spark, base), ooxml.read_cells(spark, output))


@query(
    """select 'Nations' as sheet, 'D' || (n_nationkey + 2) as ref, 'not in the patch' as reason from nation where n_nationkey % 3 = 0 and n_nationkey % 6 <> 0 union all select 'Nations', 'D' || (n_nationkey + 2), 'has another formula' from nation where n_nationkey % 6 = 0
    union all select 'Calc', 'Z99', 'no such cell'"""
)
def patch_differences(spark, sf_dir):
    """Every difference with its reason, for patches that name half of the changed cells, with another formula."""
    base, output, patches = _patched(spark, sf_dir)
    asked = [(p["sheet"], p["cell"], p["old_formula"], "9") for p in patches if (int(p["cell"][1:]) - 2) % 6 == 0] + [("Calc", "Z99", "1", "1")]
    return workbook.patch_differences(ooxml.read_cells(spark, base), ooxml.read_cells(spark, output), spark.createDataFrame(asked, "sheet string, ref string, old string, new string"))


@query("select cast(null as varchar) as blocker where false")
def patch_audit_blockers(spark, sf_dir):
    """C09 of a patch as it was made: nothing is amiss."""
    return said(spark, workbook.verify_patch(spark, *_patched(spark, sf_dir)).blockers)
