"""Normalisers against their plain-Python meaning."""

from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fiscora.functions import values


def column(spark, items, make, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", make(df.x).alias("y")).orderBy("i").select("y").collect()]


def python_number(s):
    import re

    if s is None or not re.fullmatch(r"\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*", s, re.A):
        return None
    v = float(s)
    return None if math.isinf(v) and "inf" not in s.lower() else v


NUMBERS = ["12", " 12 ", "1e3", "inf", "-Infinity", "1_000", "1,000", "0x10", "", "1d", "1f", "nan", "1e400", ".5", "5.", "+3", "--3", None, "١٢"]


def test_to_number_fixed_cases(spark):
    assert column(spark, NUMBERS, values.to_number) == [python_number(s) for s in NUMBERS]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text("0123456789.eE+- dfx_", max_size=8)), min_size=1, max_size=60))
def test_to_number_any_text(spark, items):
    assert column(spark, items, values.to_number) == [python_number(s) for s in items]


def test_to_number_of_doubles(spark):
    assert column(spark, [1.5, float("nan"), None], lambda c: values.to_number(c, "double"), "double") == [1.5, None, None]


def test_flag(spark):
    items = [None, "", "  ", "1", " TRUE ", "false", "0", "1.0", "yes", "2"]
    got = [(r["status"], r["value"]) for r in column(spark, items, values.flag)]
    assert got == [("null", None)] * 3 + [("valid", True), ("valid", True), ("valid", False), ("valid", False), ("valid", True), ("invalid", None), ("invalid", None)]


def test_flag_of_numbers_and_booleans(spark):
    assert [(r["status"], r["value"]) for r in column(spark, [1, 0, 2, None], values.flag, "int")] == [("valid", True), ("valid", False), ("invalid", None), ("null", None)]
    assert [(r["status"], r["value"]) for r in column(spark, [True, None], values.flag, "boolean")] == [("valid", True), ("null", None)]


def test_blank_and_strip(spark):
    items = [None, "", " \t", " ", "a", " a "]
    assert column(spark, items, values.is_blank) == [True, True, True, True, False, False]
    assert column(spark, items, values.normalize_name) == ["", "", "", "", "a", "a"]
    assert column(spark, items, values.is_empty) == [True, True, False, False, False, False]


def test_normalize_text_strict(spark):
    items = ["Ａ ﬁ ß", "  a\t b ", None]
    assert column(spark, items, values.normalize_text) == ["a fi ss", "a b", ""]
    assert values.normalized_text("Ａ ﬁ ß") == "a fi ss"


def test_cell_keys(spark):
    one = column(spark, [1, 0, None], lambda c: values.cell_key(c, "int"), "int")
    two = column(spark, [1.0, -0.0, float("nan")], lambda c: values.cell_key(c, "double"), "double")
    assert one == two
    flags = column(spark, [True], lambda c: values.cell_key(c, "boolean"), "boolean")
    assert flags[0] != one[0]
    assert [tuple(x) for x in column(spark, ["a", " "], values.cell_key)] == [("text", "a"), ("blank", None)]


@pytest.mark.parametrize("said, expected", [("1999", {"1999"}), ("2001-2003", {"2001", "2002", "2003"}), ("1998–1999; 2005", {"1998", "1999", "2005"}), (None, set()), ("12345", set()), ("2003-2001", {"2001", "2003"})])
def test_years(spark, said, expected):
    assert values.years(said) == expected
    assert set(column(spark, [said], values.year_array)[0]) == expected


def test_timestamps():
    assert values.timestamp_ok("2024-01-01T00:00:00Z") and values.timestamp_ok("2024-01-01T00:00:00+02:00")
    assert not any(map(values.timestamp_ok, ("2024-01-01", "2024-01-01T00:00:00", "", None, 3)))


def test_formula_tokens(spark):
    got = column(spark, ["SUM(A1)+STDEV.S(B1)*_xlfn.IFS (C1)", None, "A1"], values.function_tokens)
    assert got[0][:2] == ["SUM", "S"] and got[1:] == [[], []]
    assert column(spark, ["A1", "==A1", None], values.normalize_formula) == ["=A1", "=A1", "="]
    assert values.number_text(True) == "1" and values.number_text(0.1 + 0.2) == "0.3"


def test_ratio_and_sums(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(values.safe_ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.25, None]
    assert df.agg(values.exact_sum(F.col("a"), 2)).first()[0] == 3.0
