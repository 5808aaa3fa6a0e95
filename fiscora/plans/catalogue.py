"""The query catalogue: one query for each operator family, each with the SQL that gives the same rows.

The test tables hold no nulls, blanks or malformed numbers, so queries put them in, on both sides alike.  Money is
summed over decimals, so that sums do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import compile_rule, criterion, masks_by_code
from ..functions.values import cell_position, flag, function_tokens, normalize_text, to_number, trim_trailing_blanks, year_array
from ..operators import coverage, duplicates, flags, lineage, marts, overlap, reconcile, workbook

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- reconciliation --------------------------------------------------------------------------------------------

_RECONCILED = """
with l as (select l_orderkey as k, cast(sum(cast(l_extendedprice*(1-l_discount)*(1+l_tax) as decimal(28,6))) as double) as left_value from lineitem group by 1),
r as (select o_orderkey as k, cast(sum(cast(o_totalprice as decimal(28,6))) as double) as right_value from orders group by 1),
j as (select coalesce(l.k, r.k) as order_key, left_value, right_value, left_value-right_value as absolute_difference,
  abs(left_value-right_value)/nullif({den},0) as relative_difference, l.k is null as no_left, r.k is null as no_right
  from l full outer join r on l.k = r.k),
d as (select order_key, left_value, right_value, absolute_difference, relative_difference,
  case when no_right then 'MISSING_RIGHT' when no_left then 'MISSING_LEFT' when abs(absolute_difference) <= {abs} then 'MATCH'
       when relative_difference <= {rel} then 'MATCH' else 'DISCREPANCY' end as status from j)
"""


def _detail(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    net = F.expr("l_extendedprice*(1-l_discount)*(1+l_tax)")
    left = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"), net.alias("net"))
    right = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), "o_totalprice")
    return reconcile.compare(left, right, ["order_key"], "net", "o_totalprice", scale=6, **options)


def _reconciled(den: str = "abs(right_value)", absolute: float = 0.5, relative: float = 0.05) -> str:
    return _RECONCILED.format(den=den, abs=absolute, rel=relative)


@query(_reconciled() + "select * from d")
def reconcile_status_detail(spark, sf_dir):
    return _detail(spark, sf_dir)


@query(_reconciled() + "select status, count(*) as n from d group by 1")
def reconcile_status_counts(spark, sf_dir):
    return reconcile.status_counts(_detail(spark, sf_dir))


@query(_reconciled() + "select order_key, right_value from d where status = 'MISSING_LEFT'")
def reconcile_missing_left(spark, sf_dir):
    return _detail(spark, sf_dir).filter("status = 'MISSING_LEFT'").select("order_key", "right_value")


@query(_reconciled("greatest(abs(left_value), abs(right_value))", 100, 0.25) + "select status, count(*) as n, count(relative_difference) as with_ratio from d group by 1")
def reconcile_denominator_max(spark, sf_dir):
    d = _detail(spark, sf_dir, absolute=100, relative=0.25, denominator="max")
    return d.groupBy("status").agg(F.count("*").alias("n"), F.count("relative_difference").alias("with_ratio"))


@query(
    _reconciled("abs(left_value)")
    + """select case when order_key % 100 = 0 then 'EXPECTED_EXCLUSION' when left_value is null and right_value is null then 'BOTH_MISSING'
    when status = 'MISSING_LEFT' then 'MISSING_PIPELINE' when status = 'MISSING_RIGHT' then 'MISSING_REFERENCE' else status end as outcome, count(*) as n from d group by 1"""
)
def reconcile_taxonomy(spark, sf_dir):
    d = reconcile.taxonomy(_detail(spark, sf_dir, denominator="left"), excluded=(F.col("order_key") % 100 == 0))
    return d.groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    """with a as (select nullif(o_orderpriority, '1-URGENT') as p, o_orderstatus as s, count(*) as n from orders group by 1, 2),
    b as (select case when o_totalprice > 300000 then null else nullif(o_orderpriority, '1-URGENT') end as p, case when o_orderstatus = 'P' then 'X' else o_orderstatus end as s, count(*) as n from orders group by 1, 2)
    select coalesce(a.p, b.p) as priority, coalesce(a.s, b.s) as state, cast(a.n as double) as left_value, cast(b.n as double) as right_value,
    case when b.n is null then 'MISSING_RIGHT' when a.n is null then 'MISSING_LEFT' when abs(a.n - b.n) <= 0.5 or abs(a.n - b.n) / b.n <= 0.1 then 'MATCH' else 'DISCREPANCY' end as status
    from a full outer join b on a.p is not distinct from b.p and a.s = b.s"""
)
def reconcile_null_keys(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    priority = "nullif(o_orderpriority, '1-URGENT')"
    left = o.selectExpr(f"{priority} as priority", "o_orderstatus as state", "1.0D as one")
    right = o.selectExpr(f"case when o_totalprice > 300000 then null else {priority} end as priority", "case when o_orderstatus = 'P' then 'X' else o_orderstatus end as state", "1.0D as one")
    return reconcile.compare(left, right, ["priority", "state"], "one", "one", relative=0.1).select("priority", "state", "left_value", "right_value", "status")


_ROUGH = "case when l_linenumber = 7 then null when l_quantity = 50 then 'n/a' when l_quantity = 49 then '1_000' when l_quantity = 48 then ' 12.5 ' else cast(l_quantity as {text}) end"
_NUM = r"'^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)\s*$'"


@query(
    f"""with w as (select nullif(l_orderkey, 1) as k, {_ROUGH.format(text="varchar")} as v from lineitem),
    g as (select k, count(*) as n from w group by 1)
    select (select count(*) from w) as "rows", (select cast(coalesce(sum(n), 0) as bigint) from g where n > 1) as duplicate_key_rows, (select count(*) from w where k is null) as null_key_rows,
    (select count(*) from w where v is not null and not regexp_matches(v, {_NUM})) as invalid_value_rows, (select count(*) from w where v is null) as null_value_rows"""
)
def reconcile_input_quality(spark, sf_dir):
    w = read(spark, sf_dir, "lineitem").select(F.expr("nullif(l_orderkey, 1L)").alias("k"), F.expr(_ROUGH.format(text="string")).alias("v"))
    return reconcile.input_quality(w, ["k"], "v")


# ---- flags -----------------------------------------------------------------------------------------------------

_FLAG = "case o_orderpriority when '1-URGENT' then ' TRUE ' when '2-HIGH' then '1' when '3-MEDIUM' then 'false' when '4-NOT SPECIFIED' then case when o_orderkey % 2 = 0 then 'maybe' else '0' end else case when o_orderkey % 3 = 0 then null when o_orderkey % 3 = 1 then '  ' else '0' end end"
_FLAGGED = f"""
with f as (select o_orderkey, cast(year(o_orderdate) as bigint) as year, o_orderpriority, o_totalprice, {_FLAG} as raw from orders),
s as (select *, case when raw is null or trim(raw) = '' then 'null' when lower(trim(raw)) in ('1','true','0','false') then 'valid' else 'invalid' end as status,
  case when lower(trim(raw)) in ('1','true') then true when lower(trim(raw)) in ('0','false') then false end as flag from f)
"""


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("long").alias("year"), "o_orderpriority", "o_totalprice", F.expr(_FLAG).alias("raw"))


def _work(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _flagged(spark, sf_dir)
    return flags.measured(f, ["o_totalprice"], "year", flag(f["raw"])["value"])


def _sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flags.year_flag_sums(_work(spark, sf_dir), ["o_totalprice"], scale=2)


@query(_FLAGGED + 'select year, flag, count(*) as "rows", cast(sum(cast(o_totalprice as decimal(28,2))) as double) as o_totalprice from s where flag is not null group by 1, 2')
def flag_partition_summary(spark, sf_dir):
    return flags.partition_summary(_sums(spark, sf_dir), ["o_totalprice"])


@query(
    _FLAGGED
    + """select year, count(*) as all_rows, count(flag) as partitioned_rows, count(*) - count(flag) as row_difference, a as o_totalprice_all,
    case when count(flag) = 0 then 0.0 else p end as o_totalprice_partitioned, a - case when count(flag) = 0 then 0.0 else p end as o_totalprice_difference
    from (select *, cast(sum(cast(o_totalprice as decimal(28,2))) over (partition by year) as double) as a,
      cast(sum(case when flag is not null then cast(o_totalprice as decimal(28,2)) end) over (partition by year) as double) as p from s) group by year, a, p"""
)
def flag_conservation(spark, sf_dir):
    return flags.conservation(_sums(spark, sf_dir), ["o_totalprice"])


_URGENT = {"description": "urgent or high priority", "branches": [{"all": [{"column": "o_orderpriority", "operator": "starts_with", "value": "1-"}]}, {"all": [{"column": "o_orderpriority", "operator": "in", "value": ["2-high"]}]}]}


@query(_FLAGGED + "select o_orderkey, flag as published, (o_orderpriority like '1-%' or o_orderpriority = '2-HIGH' or o_totalprice > 400000) as derived from s where flag is not null and flag <> (o_orderpriority like '1-%' or o_orderpriority = '2-HIGH' or o_totalprice > 400000)")
def flag_mismatch_rows(spark, sf_dir):
    from ..functions.predicates import derived_flag

    f = _flagged(spark, sf_dir)
    config = {"description": "x", "branches": [*_URGENT["branches"], {"all": [{"column": "o_totalprice", "operator": "gt", "value": 400000}]}]}
    derived, _ = derived_flag(f, config, {"raw"})
    out = flag(f["raw"])
    return f.select("o_orderkey", out["value"].alias("published"), derived.alias("derived")).filter("published is not null and published <> derived")


@query(_FLAGGED + "select status, flag, count(*) as n from s group by 1, 2")
def flag_domain(spark, sf_dir):
    f = _flagged(spark, sf_dir)
    return f.select(flag(f["raw"]).alias("f")).groupBy(F.col("f.status").alias("status"), F.col("f.value").alias("flag")).agg(F.count("*").alias("n"))


# ---- predicates ------------------------------------------------------------------------------------------------

_T = "case when p_size % 10 = 0 then null when p_size % 10 = 1 then '  ' else p_type end"
_S = "case when p_size % 7 = 0 then null when p_size % 7 = 1 then 'n/a' else cast(p_size as {text}) end"
_A_OPS = {
    "is_null": ("t", {"operator": "is_null"}, "t is null or trim(t) = ''"),
    "not_null": ("t", {"operator": "not_null"}, "not (t is null or trim(t) = '')"),
    "lt": ("s", {"operator": "lt", "value": 20}, "coalesce(try_cast(s as double) < 20, false)"),
    "le": ("s", {"operator": "le", "value": "20"}, "coalesce(try_cast(s as double) <= 20, false)"),
    "gt": ("s", {"operator": "gt", "value": 20}, "coalesce(try_cast(s as double) > 20, false)"),
    "ge": ("p_retailprice", {"operator": "ge", "value": 1000}, "p_retailprice >= 1000"),
    "equals": ("t", {"operator": "equals", "value": "standard"}, "lower(coalesce(t, '')) = 'standard'"),
    "equals_case": ("t", {"operator": "equals", "value": "standard", "case_sensitive": True}, "coalesce(t, '') = 'standard'"),
    "not_equals": ("t", {"operator": "not_equals", "value": "STANDARD"}, "lower(coalesce(t, '')) <> 'standard'"),
    "starts_with": ("t", {"operator": "starts_with", "value": "s"}, "starts_with(lower(coalesce(t, '')), 's')"),
    "contains": ("t", {"operator": "contains", "value": "A"}, "contains(lower(coalesce(t, '')), 'a')"),
    "regex": ("t", {"operator": "regex", "value": "^(small|medium)$"}, "regexp_matches(coalesce(t, ''), '(?i)^(small|medium)$')"),
    "in_list": ("t", {"operator": "in", "value": ["Promo", "economy"]}, "lower(coalesce(t, '')) in ('promo', 'economy')"),
    "not_in_list": ("t", {"operator": "not_in", "value": ["promo"]}, "lower(coalesce(t, '')) not in ('promo')"),
    "not_folded": ("t", {"operator": "equals", "value": True}, "false"),
}


@query(f"with p as (select *, {_T} as t, {_S.format(text='varchar')} as s from part) select p_partkey, " + ", ".join(f"({sql}) as {name}" for name, (_, _, sql) in _A_OPS.items()) + " from p")
def predicate_a_all_ops(spark, sf_dir):
    p = read(spark, sf_dir, "part").withColumn("t", F.expr(_T)).withColumn("s", F.expr(_S.format(text="string")))
    kinds = dict(p.dtypes)
    return p.select("p_partkey", *[criterion(p[c], spec, kinds[c]).alias(name) for name, (c, spec, _) in _A_OPS.items()])


def _rule_columns(df: DataFrame, rules: dict[str, object], fields: dict[str, str], years: dict[str, str] | None = None) -> list:
    import json

    compiled = [compile_rule(df, {"code": n, "criteria_json": json.dumps(c), "years_covered": (years or {}).get(n)}, fields) for n, c in rules.items()]
    return [m.alias(n) for n, m in masks_by_code(compiled).items()]


@query(
    f"""with p as (select *, {_T} as t from part) select p_partkey, regexp_matches(coalesce(t, ''), '(?i)^.*a.*$') as has_a, regexp_matches(coalesce(t, ''), '(?i)^s.*d$') as s_to_d,
    regexp_matches(coalesce(t, ''), '(?i)^.m.*$') as second_m, not regexp_matches(coalesce(t, ''), '(?i)^s.*$') as not_s, lower(coalesce(t, '')) = '' as empty, lower(coalesce(t, '')) <> 'promo' as not_promo from p"""
)
def predicate_b_wildcards(spark, sf_dir):
    p = read(spark, sf_dir, "part").withColumn("t", F.expr(_T))
    one = lambda op, v: [{"field": "type", "op": op, "value": v}]
    rules = {"has_a": one("=", "*a*"), "s_to_d": one("=", "S*D"), "second_m": one("=", "?m*"), "not_s": one("<>", "s*"), "empty": one("=", None), "not_promo": one("<>", "PROMO")}
    return p.select("p_partkey", *_rule_columns(p, rules, {"type": "t"}))


@query(
    f"""with p as (select *, {_T} as t from part) select p_partkey, lower(coalesce(t, '')) in ('promo', 'small') as any_of, lower(coalesce(t, '')) not in ('promo', 'small') as none_of,
    (lower(coalesce(t, '')) in ('economy') or regexp_matches(coalesce(t, ''), '(?i)^st.*$')) and p_size > 10 as list_and, lower(coalesce(t, '')) = 'promo' as order_of_list from p"""
)
def predicate_b_lists(spark, sf_dir):
    p = read(spark, sf_dir, "part").withColumn("t", F.expr(_T))
    rules = {
        "any_of": [{"field": "type", "value": ["Promo", "SMALL"]}], "none_of": [{"field": "type", "op": "<>", "value": ["promo", "small"]}],
        "list_and": [{"field": "type", "value": ["economy", "st*"]}, {"field": "size", "op": ">", "value": "10"}], "order_of_list": [{"field": "type", "op": "<", "value": ["promo"]}],
    }
    return p.select("p_partkey", *_rule_columns(p, rules, {"type": "t", "size": "p_size"}))


@query(
    f"""with p as (select *, try_cast({_S.format(text='varchar')} as double) as n from part) select p_partkey, coalesce(n < 10, false) as lt, coalesce(n <= 10, false) as le, coalesce(n > 40.5, false) as gt, coalesce(n >= 40, false) as ge,
    coalesce((n >= 10 and n < 20) or n = 45, false) as branches from p"""
)
def predicate_b_numeric(spark, sf_dir):
    p = read(spark, sf_dir, "part").withColumn("s", F.expr(_S.format(text="string")))
    one = lambda op, v: {"field": "size", "op": op, "value": v}
    rules = {"lt": [one("<", 10)], "le": [one("<=", "10")], "gt": [one(">", "40.5")], "ge": [one(">=", 40)], "branches": [[one(">=", 10), one("<", 20)], [one("=", "45")]]}
    return p.select("p_partkey", *_rule_columns(p, rules, {"size": "s"}))


@query(
    """with o as (select o_orderkey, nullif(year(o_orderdate), 1997) as y, o_orderstatus as s from orders) select o_orderkey, coalesce(s = 'F' and y in (1995, 1996, 1997, 1998), false) as ranged,
    coalesce(s <> 'F' and y in (1995, 1999), false) as listed, s = 'O' as always from o"""
)
def predicate_b_years(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.expr("nullif(year(o_orderdate), 1997)").alias("y"), F.col("o_orderstatus").alias("s"))
    rules = {"ranged": [{"field": "state", "value": "f"}], "listed": [{"field": "state", "op": "<>", "value": "F"}], "always": [{"field": "state", "value": "O"}, {"field": "state", "op": "=year", "value": None}]}
    return o.select("o_orderkey", *_rule_columns(o, rules, {"state": "s", "year": "y"}, {"ranged": "1995-1998", "listed": "FY 1995, and 1999"}))


# ---- overlap ---------------------------------------------------------------------------------------------------

_LINES = "select l_returnflag as f, l_linestatus as s, l_quantity as q, nullif(cast(year(l_shipdate) as int), 1996) as y, case when l_linenumber = 5 then null else l_extendedprice end as amount from lineitem"
_CODES = [
    {"code": "E1", "tag_kind": "primary", "econ": "Goods"}, {"code": "E2", "tag_kind": "primary", "econ": "Goods"}, {"code": "E3", "tag_kind": "primary", "econ": "Services"},
    {"code": "F1", "tag_kind": "primary", "func": "Health"}, {"code": "F2", "tag_kind": "primary", "func": "Roads"},
    {"code": "X_SBN_1", "tag_kind": "primary", "econ": "Goods", "econ_sub": "Fuel"}, {"code": "X_SBN_2", "tag_kind": "primary", "econ": "Goods", "econ_sub": "Food"},
]
_RULES = {
    "E1": '[{"field":"flag","value":"A"}]', "E2": '[[{"field":"flag","value":"a"},{"field":"qty","op":">","value":25}],[{"field":"qty","op":">","value":"40"}]]',
    "E3": '[{"field":"state","value":"F"},{"field":"qty","op":"<=","value":30}]', "F1": '[{"field":"flag","op":"<>","value":"N"}]', "F2": '[{"field":"qty","op":"<","value":5}]',
    "X_SBN_1": '[{"field":"flag","value":["R","A"]}]', "X_SBN_2": '[{"field":"state","value":"?"},{"field":"qty","op":">=","value":45}]',
}
_MASKS = {
    "E1": "f = 'A'", "E2": "(f = 'A' and q > 25) or q > 40", "E3": "s = 'F' and q <= 30", "F1": "f <> 'N'", "F2": "q < 5 and coalesce(y in (1997, 1998), false)", "X_SBN_1": "f in ('R', 'A')", "X_SBN_2": "q >= 45",
}
_GROUP = {"E1": ("primary", "econ"), "E2": ("primary", "econ"), "E3": ("primary", "econ"), "F1": ("primary", "func"), "F2": ("primary", "func"), "X_SBN_1": ("subnational", "econ_sub"), "X_SBN_2": ("subnational", "econ_sub")}
_MET = f"with l as ({_LINES}), n as (select *, row_number() over () as id, coalesce(amount, 0) as v from l), m as (" + " union all ".join(
    f"select id, v, y, '{scope}' as scope, '{level}' as level, '{c}' as code from n where {_MASKS[c]}" for c, (scope, level) in _GROUP.items()
) + ")"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag as f", "l_linestatus as s", "l_quantity as q", "nullif(cast(year(l_shipdate) as int), 1996) as y", "case when l_linenumber = 5 then null else l_extendedprice end as amount"
    )


def _compiled(df: DataFrame) -> list:
    fields = {"flag": "f", "state": "s", "qty": "q", "year": "y"}
    return [compile_rule(df, {"code": c, "criteria_json": j, "years_covered": "1997-1998" if c == "F2" else None}, fields) for c, j in _RULES.items()]


def _met(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _lines(spark, sf_dir)
    return overlap.memberships(df, masks_by_code(_compiled(df)), overlap.candidate_groups(_CODES), ["amount"], "y", scale=2)


_SUM = "cast(sum(cast({} as decimal(28,2))) as double)"


@query(_MET + f"select scope, 'primary' as tag_kind, level, code, count(*) as \"rows\", {_SUM.format('v')} as amount from m group by 1, 2, 3, 4")
def overlap_code_totals(spark, sf_dir):
    return overlap.code_totals(_met(spark, sf_dir), ["amount"], scale=2)


@query(
    _MET
    + f""", t as (select scope, level, code, {_SUM.format('v')} as total from m group by 1, 2, 3),
    p as (select a.scope, a.level, a.code as code_a, b.code as code_b, count(*) as n, {_SUM.format('a.v')} as o from m a join m b on a.id = b.id and a.scope = b.scope and a.level = b.level and a.code < b.code group by 1, 2, 3, 4)
    select p.scope, 'primary' as tag_kind, p.level, code_a, code_b, n as "rows", ta.total as amount_a, tb.total as amount_b, o as amount_overlap, o / nullif(least(abs(ta.total), abs(tb.total)), 0) as amount_ratio
    from p join t ta on ta.code = code_a and ta.level = p.level join t tb on tb.code = code_b and tb.level = p.level"""
)
def overlap_pairs(spark, sf_dir):
    return overlap.pair_overlaps(_met(spark, sf_dir), ["amount"], scale=2)


@query(
    _MET
    + f"""select a.scope, 'primary' as tag_kind, a.level, a.code as code_a, b.code as code_b, cast(a.y as varchar) as year, count(*) as "rows", {_SUM.format('a.v')} as amount_overlap
    from m a join m b on a.id = b.id and a.scope = b.scope and a.level = b.level and a.code < b.code group by 1, 2, 3, 4, 5, 6"""
)
def overlap_pairs_by_year(spark, sf_dir):
    return overlap.pair_overlaps(_met(spark, sf_dir), ["amount"], by_year=True, scale=2)


@query(
    _MET
    + f""", k as (select scope, level, id, v, y, count(*) as k from m group by 1, 2, 3, 4, 5 having count(*) > 1)
    select scope, 'primary' as tag_kind, level, cast(y as varchar) as year, count(*) as unique_affected_rows, max(k) as max_memberships, {_SUM.format('v')} as amount_exposure, {_SUM.format('v * (k - 1)')} as amount_net_excess
    from k where y is not null group by 1, 2, 3, 4"""
)
def overlap_net_excess(spark, sf_dir):
    return overlap.net_excess(_met(spark, sf_dir), ["amount"], True, scale=2)


@query(f"with l as ({_LINES}) select 'E2' as code, count(*) as \"rows\", cast(2 as bigint) as max_branch_memberships, {_SUM.format('coalesce(amount, 0)')} as amount_exposure, {_SUM.format('coalesce(amount, 0)')} as amount_net_excess from l where f = 'A' and q > 40")
def overlap_self_double(spark, sf_dir):
    df = _lines(spark, sf_dir)
    return overlap.self_doubles(df, _compiled(df), ["amount"], scale=2).drop("rule")


# ---- duplicates ------------------------------------------------------------------------------------------------


@query("select min(doc_id) as first_row, count(*) as n from documents where trim(text) <> '' group by text having count(*) > 1")
def dup_exact_documents(spark, sf_dir):
    return duplicates.duplicate_groups(read(spark, sf_dir, "documents"), ["text"], "doc_id", complete_only=True).select("first_row", "n")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def dup_key_lineitem(spark, sf_dir):
    return marts.repeated_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select l_orderkey, k, l_quantity from (select *, nullif(l_linenumber, 3) as k, count(*) over (partition by l_orderkey, nullif(l_linenumber, 3)) as n from lineitem) where n > 1")
def dup_rows_window(spark, sf_dir):
    w = read(spark, sf_dir, "lineitem").select("l_orderkey", F.expr("nullif(l_linenumber, 3)").alias("k"), "l_quantity")
    return reconcile.duplicated_rows(w, ["l_orderkey", "k"])


@query("select l_orderkey as o, l_linenumber as l, count(*) as n from lineitem where not (l_orderkey = 1 and l_linenumber = 1) group by 1, 2 having count(*) > 1")
def dup_allowed_exceptions(spark, sf_dir):
    allowed = spark.createDataFrame([(1, 1)], "o long, l int")
    repeated = marts.repeated_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return repeated.join(allowed, (F.col("l_orderkey") == F.col("o")) & (F.col("l_linenumber") == F.col("l")), "left_anti").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"), "n")


_C = "case when c_custkey % 11 = 0 then null when c_custkey % 11 = 1 then '  ' else c_mktsegment end"


@query(f"select c_custkey, seg from (select c_custkey, {_C} as seg from customer) where seg is null or trim(seg) = ''")
def incomplete_key_rows(spark, sf_dir):
    return duplicates.incomplete_keys(read(spark, sf_dir, "customer").select("c_custkey", F.expr(_C).alias("seg")), ["c_custkey", "seg"])


@query("select regexp_replace(lower(trim(label)), '\\s+', ' ', 'g') as normalized, count(*) as n from (select p_type || '  ' || upper(p_brand) as label from part) group by 1 having count(*) > 1")
def dup_normalized_labels(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(normalize_text(F.expr("p_type || '  ' || upper(p_brand)")).alias("normalized"))
    return marts.repeated_keys(p, ["normalized"])


# ---- coverage --------------------------------------------------------------------------------------------------

_MAPPING = "select n_name as source, case when n_nationkey % 9 = 4 then 'ATLANTIS' else r_name end as target from nation join region on n_regionkey = r_regionkey where n_nationkey % 8 <> 5"
_COVERED = f"""with map as ({_MAPPING}), units as (select r_name as unit from region union all select 'NOWHERE'),
w as (select trim(n_name) as source_name, coalesce(map.target, trim(n_name)) as target_name, year(o_orderdate) as y, case when o_orderkey % 50 = 0 then null when o_orderkey % 50 = 1 then 'x' when o_orderkey % 50 = 2 then '-1' else cast(o_totalprice as varchar) end as v
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey left join map on map.source = trim(n_name) where not (n_regionkey = 2 and year(o_orderdate) > 1997)) """


def _covered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    mapping = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).filter("n_nationkey % 8 <> 5").selectExpr("n_name as source", "case when n_nationkey % 9 = 4 then 'ATLANTIS' else r_name end as target")
    rows = (
        read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .filter("not (n_regionkey = 2 and year(o_orderdate) > 1997)")
        .selectExpr("concat(' ', n_name, ' ') as name", "year(o_orderdate) as y", "case when o_orderkey % 50 = 0 then null when o_orderkey % 50 = 1 then 'x' when o_orderkey % 50 = 2 then '-1' else cast(o_totalprice as string) end as v")
    )
    units = region.selectExpr("r_name as unit").unionByName(spark.createDataFrame([("NOWHERE",)], "unit string"))
    return coverage.mapped(rows, "name", mapping), units


@query(_COVERED + "select distinct target_name from w where target_name <> '' and target_name not in (select unit from units)")
def coverage_unmatched(spark, sf_dir):
    return coverage.unmatched(*_covered(spark, sf_dir))


@query(_COVERED + "select unit from units where unit not in (select target_name from w)")
def coverage_missing_targets(spark, sf_dir):
    return coverage.missing_units(*_covered(spark, sf_dir))


@query(_COVERED + "select cast(yy as int) as year, unit from units cross join (select unnest([1996, 1998, 2001, 2050]) as yy) where unit <> 'NOWHERE' and not exists (select 1 from w where target_name = unit and y = yy)")
def coverage_year_gaps(spark, sf_dir):
    work, units = _covered(spark, sf_dir)
    return coverage.year_gaps(work, units, "y", [1996, 1998, 2001, 2050], spark.createDataFrame([("NOWHERE",)], "unit string"))


@query(_COVERED + "select target_name, array_to_string(list_sort(list(distinct source_name)), '|') as source_names from w where target_name <> '' group by 1 having count(distinct source_name) > 1")
def coverage_collisions(spark, sf_dir):
    return coverage.collisions(_covered(spark, sf_dir)[0]).withColumn("source_names", F.array_join("source_names", "|"))


@query(_COVERED + 'select count(*) filter (where v is null) as "null", count(*) filter (where v = \'x\') as nonnumeric, count(*) filter (where v = \'-1\') as negative from w')
def coverage_value_stats(spark, sf_dir):
    return coverage.value_stats(_covered(spark, sf_dir)[0], "v")


@query(_COVERED + ", g as (select target_name, y, count(*) as n from w group by 1, 2 having count(*) > 1) select cast(coalesce(sum(n), 0) as bigint) as duplicate_rows from g")
def coverage_duplicate_rows(spark, sf_dir):
    return coverage.duplicate_key_rows(coverage.cells(_covered(spark, sf_dir)[0], "y", "v"), "y")


@query("select doc_id as unit from documents where doc_id not in (select doc_id from labels) and doc_id % 10 <> 0")
def coverage_no_data(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("unit"))
    return coverage.missing_units(read(spark, sf_dir, "labels").select(F.col("doc_id").alias("target_name")), docs, docs.filter("unit % 10 = 0"))


# ---- marts -----------------------------------------------------------------------------------------------------


@query(
    f"""select owner, count(*) as n, {_SUM.format('l_extendedprice')} as amount from (select *, case when l_returnflag = 'R' and l_quantity > 30 then 'returned-large' when l_returnflag = 'R' then 'returned'
    when l_discount >= 0.05 then 'discounted' else 'other' end as owner from lineitem) group by 1"""
)
def owner_cascade(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    rules = [((li.l_returnflag == "R") & (li.l_quantity > 30), "returned-large"), (li.l_returnflag == "R", "returned"), (li.l_discount >= 0.05, "discounted")]
    return li.groupBy(marts.owner_cascade(rules, "other").alias("owner")).agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(28,2)")).cast("double").alias("amount"))


_GOLD = "select n_name as nation, c_mktsegment as segment, cast(year(o_orderdate) as bigint) as year, o_totalprice as amount from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.selectExpr("n_name as nation", "c_mktsegment as segment", "cast(year(o_orderdate) as bigint) as year", "o_totalprice as amount")


@query(
    f"""with g as ({_GOLD}) select year, nation, segment, cast(grouping_id(year, nation, segment) as bigint) as grouping, count(*) as "rows", {_SUM.format('amount')} as amount from g
    group by grouping sets ((year), (year, nation), (year, segment), (year, nation, segment))"""
)
def comparison_matrix(spark, sf_dir):
    return marts.comparison_matrix(_gold(spark, sf_dir), [["year"], ["year", "nation"], ["year", "segment"], ["year", "nation", "segment"]], ["amount"], scale=2)


@query(
    """select count(*) as "rows", count(*) filter (where seg is null) as null_seg, count(*) filter (where bal is null) as null_bal, count(*) filter (where c_name is null) as null_c_name
    from (select c_name, nullif(c_mktsegment, 'BUILDING') as seg, case when c_acctbal < 0 then null else c_acctbal end as bal from customer)"""
)
def null_profile(spark, sf_dir):
    c = read(spark, sf_dir, "customer").selectExpr("c_name", "nullif(c_mktsegment, 'BUILDING') as seg", "case when c_acctbal < 0 then null else c_acctbal end as bal")
    return marts.null_profile(c, ["seg", "bal", "c_name"])


@query(f'with g as ({_GOLD}) select year, count(*) as "rows", {_SUM.format("amount")} as amount from g group by 1')
def year_totals(spark, sf_dir):
    return marts.totals(_gold(spark, sf_dir), ["year"], ["amount"], scale=2)


@query(f'with g as ({_GOLD}) select segment, year, count(*) as "rows" from g group by 1, 2')
def segment_year_counts(spark, sf_dir):
    return marts.totals(_gold(spark, sf_dir), ["segment", "year"], [])


@query(_FLAGGED + f'select year, flag, count(*) as "rows", {_SUM.format("o_totalprice")} as o_totalprice from s group by 1, 2')
def flag_year_totals(spark, sf_dir):
    return marts.totals(_work(spark, sf_dir), ["year", "flag"], ["o_totalprice"], scale=2)


@query(
    f"""select position, layer, "rows", amount from (select 0 as position, 'raw' as layer, count(*) as "rows", {_SUM.format('l_extendedprice')} as amount from lineitem
    union all select 1, 'bronze', count(*), {_SUM.format('l_extendedprice')} from lineitem where l_quantity is not null
    union all select 2, 'silver', count(*), {_SUM.format('l_extendedprice')} from lineitem where l_discount < 0.1
    union all select 3, 'gold', count(*), {_SUM.format('l_extendedprice')} from lineitem where l_discount < 0.1 and l_returnflag <> 'N')"""
)
def layer_conservation(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    silver = li.filter("l_discount < 0.1")
    layers = [("raw", li), ("bronze", li.filter("l_quantity is not null")), ("silver", silver), ("gold", silver.filter("l_returnflag <> 'N'"))]
    return marts.layer_conservation(layers, "l_extendedprice", scale=2)


@query(f'with g as ({_GOLD}), x as (select n_name as source, r_name as target from nation join region on n_regionkey = r_regionkey) select target, year, count(*) as "rows", {_SUM.format("amount")} as amount from g join x on nation = source group by 1, 2')
def crosswalk_aggregate(spark, sf_dir):
    walk = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).selectExpr("n_name as source", "r_name as target")
    return marts.crosswalk_sums(_gold(spark, sf_dir), "nation", walk, ["year"], ["amount"], scale=2)


@query(
    """with x as (select n_name as source, case when n_nationkey % 6 = 1 then 'TWICE' else 'ONCE' end as target from nation where n_nationkey % 5 <> 0 union all select n_name, 'AGAIN' from nation where n_nationkey % 6 = 1 and n_nationkey % 5 <> 0)
    select source, 'several targets' as problem from x group by 1 having count(distinct target) > 1 union all select n_name, 'no target' from nation where n_name not in (select source from x)"""
)
def crosswalk_problems(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    some = n.filter("n_nationkey % 5 <> 0")
    walk = some.selectExpr("n_name as source", "case when n_nationkey % 6 = 1 then 'TWICE' else 'ONCE' end as target").unionByName(some.filter("n_nationkey % 6 = 1").selectExpr("n_name as source", "'AGAIN' as target"))
    return marts.crosswalk_problems(n, "n_name", walk)


@query(
    f"""with g as ({_GOLD}), t as (select nation, {_SUM.format('amount')} as amount from g group by 1), p as (select n_name, count(*) as people from customer join nation on c_nationkey = n_nationkey where n_nationkey % 7 <> 2 group by 1)
    select nation, amount, people as population, amount / people as per_unit from t left join p on nation = n_name"""
)
def per_unit_join(spark, sf_dir):
    t = marts.totals(_gold(spark, sf_dir), ["nation"], ["amount"], scale=2).drop("rows")
    people = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).filter("n_nationkey % 7 <> 2").groupBy(F.col("n_name").alias("nation")).agg(F.count("*").alias("people"))
    return marts.per_unit(t, people, ["nation"], "amount", "people")


@query("select p_partkey, code, case code when 'E' then 'Economy goods' when 'P' then 'Promoted goods' end as label from (select p_partkey, substr(p_type, 1, 1) as code from part)")
def label_codes(spark, sf_dir):
    codes = spark.createDataFrame([("E", "Economy goods"), ("P", "Promoted goods")], "code string, label string")
    return marts.label_codes(read(spark, sf_dir, "part").selectExpr("p_partkey", "substr(p_type, 1, 1) as code"), "code", codes, "code", ["label"])


@query("with m as (select n_name as source, r_name as target from nation join region on n_regionkey = r_regionkey where n_nationkey <> 7) select s_suppkey, coalesce(target, n_name) as region, coalesce(target, n_name) in (select r_name from region) as on_map from supplier join nation on s_nationkey = n_nationkey left join m on source = n_name")
def region_contract(spark, sf_dir):
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    mapping = n.filter("n_nationkey <> 7").join(r, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr("n_name as source", "r_name as target")
    rows = read(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return marts.region_contract(rows, "n_name", mapping, r, "r_name").select("s_suppkey", "region", "on_map")


@query("select country_name, count(*) as n, count(extra) as with_extra from (select 'A' as country_name, null as extra from orders where o_orderkey % 2 = 0 union all select 'B', o_orderstatus from orders where o_orderkey % 2 = 1) group by 1")
def union_countries(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    both = marts.union_countries({"A": o.filter("o_orderkey % 2 = 0").select("o_orderkey"), "B": o.filter("o_orderkey % 2 = 1").selectExpr("o_orderkey", "o_orderstatus as extra")})
    return both.groupBy("country_name").agg(F.count("*").alias("n"), F.count("extra").alias("with_extra"))


@query(f"with g as ({_GOLD}) select distinct nation, year, case when year = 1996 then 'DISCREPANCY' else 'MISSING_LEFT' end as status from g where year = 1996 or (year = 1999 and nation like 'A%')")
def dashboard_differences(spark, sf_dir):
    truth = marts.totals(_gold(spark, sf_dir), ["nation", "year"], ["amount"], scale=2).drop("rows")
    shown = truth.withColumn("amount", F.when(F.col("year") == 1996, F.col("amount") + 1).otherwise(F.col("amount"))).filter("not (year = 1999 and nation like 'A%')")
    d = marts.dashboard_differences(shown, truth, ["nation", "year"], "amount")
    return d.select("nation", "year", "status")


@query("select count(*) filter (where not known) as unmatched, (select count(*) from nation where n_nationkey >= 20) as no_data, min(c) as legend_min, max(c) as legend_max from (select n_name, n_nationkey <> 3 as known, count(*) as c from customer join nation on c_nationkey = n_nationkey where n_nationkey < 20 group by 1, 2)")
def map_ranges(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    values = read(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).filter("n_nationkey < 20").groupBy("n_name").agg(F.count("*").alias("c"))
    return marts.map_ranges(values, "n_name", "c", n.filter("n_nationkey <> 3").selectExpr("n_name as unit"), "unit")


# ---- lineage, cells, values --------------------------------------------------------------------------------------

_EDGES = "(values ('gold', 'silver'), ('silver', 'bronze'), ('bronze', 'raw'), ('map', 'map'), ('gold', 'lost')) as e(id, parent)"
_SOURCES = [{"id": "gold", "derived_from": ["silver", "lost"]}, {"id": "silver", "derived_from": ["bronze"]}, {"id": "bronze", "derived_from": ["raw"]}, {"id": "map", "derived_from": ["map"]}, {"id": "raw"}]


@query(f"select id, parent from {_EDGES} where parent not in ('gold', 'silver', 'bronze', 'map', 'raw')")
def lineage_dangling(spark, sf_dir):
    return lineage.dangling(lineage.edges(spark, _SOURCES), spark.createDataFrame([(s["id"],) for s in _SOURCES], "id string"))


@query(f"select id, parent from {_EDGES} where id = parent")
def lineage_self(spark, sf_dir):
    return lineage.loops(lineage.edges(spark, _SOURCES))


# (sheet, row, column, has formula, formula, type, value)
_CELLS = [
    ("S", 1, 1, True, "SUM(A2:A9)+STDEV.S(B1)", None, "12"), ("S", 1, 2, True, "OFFSET(A1,1,1)*now()", None, None), ("S", 1, 3, False, None, "n", "7"), ("S", 2, 1, True, "IF(A1>0,SUM(A1),0)", None, ""), ("S", 2, 2, False, None, None, "8"),
    ("S", 3, 1, True, "A1+A2", "e", "#REF!"), ("S", 4, 1, False, None, "n", "41"), ("S", 4, 2, False, None, "s", "label"), ("T", 1, 1, False, None, "n", "5"), ("T", 2, 1, True, "RAND()", None, "0.5"), ("T", 2, 2, False, None, "n", "x"),
]


def _sql_value(v: object) -> str:
    return "null" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


_CELL_SQL = "with c as (select *, chr(64 + col_num) as col, chr(64 + col_num) || \"row\" as ref from (values " + ", ".join("(" + ", ".join(map(_sql_value, r)) + ")" for r in _CELLS) + ') as v(sheet, "row", col_num, has_formula, formula, cell_type, value)) '


def _cells(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(_CELLS, "sheet string, row int, col_num int, has_formula boolean, formula string, cell_type string, value string")
    letter = F.char(F.col("col_num") + 64)
    return df.withColumn("col", letter).withColumn("ref", F.concat(letter, F.col("row").cast("string")))


@query(_CELL_SQL + "select sheet, ref, array_to_string([regexp_extract(upper(x), '([^.]*)$', 1) for x in regexp_extract_all(formula, '(?i)\\b([A-Z][A-Z0-9_.]*)\\s*\\(', 1)], ',') as functions from c where has_formula")
def formula_tokens(spark, sf_dir):
    return _cells(spark).filter("has_formula").select("sheet", "ref", F.array_join(function_tokens(F.col("formula")), ",").alias("functions"))


@query(_CELL_SQL + "select sheet, ref, formula from c where has_formula and regexp_matches(formula, '(?i)\\b(INDIRECT|OFFSET|NOW|TODAY|RAND|RANDBETWEEN|CELL|INFO)\\s*\\(')")
def volatile_cells(spark, sf_dir):
    return workbook.volatile_cells(_cells(spark)).drop("functions")


@query(_CELL_SQL + "select sheet, ref, value from (select *, count(*) filter (where has_formula) over (partition by sheet, \"row\") as r, count(*) filter (where has_formula) over (partition by sheet, col) as k from c) where not has_formula and coalesce(cell_type, 'n') = 'n' and try_cast(value as double) is not null and (r >= 2 or k >= 3)")
def hardcoded_suspects(spark, sf_dir):
    return workbook.hardcoded_suspects(_cells(spark))


@query(_CELL_SQL + "select sheet, ref, formula from c where has_formula and (value is null or value = '')")
def missing_cache_cells(spark, sf_dir):
    return workbook.without_cache(_cells(spark))


@query(_CELL_SQL + "select sheet, fn as function, count(*) as n from (select sheet, unnest(regexp_extract_all(upper(formula), '\\b(?:[A-Z][A-Z0-9_]*\\.)*([A-Z][A-Z0-9_]*)\\s*\\(', 1)) as fn from c where has_formula) group by 1, 2 order by n desc, sheet, fn limit 4")
def top_functions(spark, sf_dir):
    return workbook.functions_used(_cells(spark)).orderBy(F.desc("n"), "sheet", "function").limit(4)


_TEXTS = ["12", " 12 ", "+.5", "5.", "1e3", "-7E-2", "1_000", "1,000", "0x10", "1d", "1f", "NaN", "", "  ", "abc", "12a"]


@query("with v as (select unnest([" + ", ".join(_sql_value(t) for t in _TEXTS) + f"]) as said) select said, case when regexp_matches(said, {_NUM}) then try_cast(trim(said) as double) end as number from v")
def numeric_coercion(spark, sf_dir):
    df = spark.createDataFrame([(t,) for t in _TEXTS], "said string")
    return df.select("said", to_number(df.said).alias("number"))


@query("select * from (values ('1999', '1999'), ('2001-2003', '2001,2002,2003'), ('FY 1995 and 1998–1999', '1995,1998,1999'), ('none', ''), ('2003-2001', '2001,2003')) as v(said, years)")
def year_ranges(spark, sf_dir):
    df = spark.createDataFrame([("1999",), ("2001-2003",), ("FY 1995 and 1998–1999",), ("none",), ("2003-2001",)], "said string")
    return df.select("said", F.array_join(year_array(df.said), ",").alias("years"))


@query("select * from (values ('A1', 1, 1), ('Z9', 26, 9), ('AA10', 27, 10), ('XFD1048576', 16384, 1048576), ('bad', null, null), ('A', null, null)) as v(ref, col_num, row_num)")
def cell_references(spark, sf_dir):
    df = spark.createDataFrame([("A1",), ("Z9",), ("AA10",), ("XFD1048576",), ("bad",), ("A",)], "ref string")
    column, row = cell_position(df.ref)
    return df.select("ref", column.alias("col_num"), row.alias("row_num"))


@query("select * from (values (1, 'a|b'), (2, 'a||b'), (3, ''), (4, '')) as v(id, header)")
def trimmed_headers(spark, sf_dir):
    df = spark.createDataFrame([(1, ["a", "b", " ", None]), (2, ["a", "", "b"]), (3, ["", " "]), (4, [])], "id int, labels array<string>")
    return df.select("id", F.array_join(trim_trailing_blanks(df.labels), "|").alias("header"))


# ---- sets and limits -------------------------------------------------------------------------------------------


@query("select l_shipdate as day from lineitem except select o_orderdate from orders")
def set_difference(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").selectExpr("l_shipdate as day").subtract(read(spark, sf_dir, "orders").select("o_orderdate"))


@query("select c_nationkey as k from customer where c_acctbal < 0 intersect select s_nationkey from supplier")
def set_intersect(spark, sf_dir):
    return read(spark, sf_dir, "customer").filter("c_acctbal < 0").selectExpr("c_nationkey as k").intersect(read(spark, sf_dir, "supplier").select("s_nationkey"))


@query("select c_nationkey as k from customer where c_acctbal > 9000 union select s_nationkey from supplier where s_acctbal < 0")
def set_union(spark, sf_dir):
    return read(spark, sf_dir, "customer").filter("c_acctbal > 9000").selectExpr("c_nationkey as k").union(read(spark, sf_dir, "supplier").filter("s_acctbal < 0").select("s_nationkey")).distinct()


@query(_FLAGGED + "select o_orderkey, raw, status from s where status <> 'valid' order by o_orderkey limit 25")
def sample_offenders(spark, sf_dir):
    f = _flagged(spark, sf_dir)
    out = flag(f["raw"])
    return f.select("o_orderkey", "raw", out["status"].alias("status")).filter("status <> 'valid'").orderBy("o_orderkey").limit(25)


from . import audits  # noqa: E402, F401  (its queries are a part of the catalogue)
