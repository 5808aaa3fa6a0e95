
from __future__ import annotations

import json

import pytest

from fiscora.operators import coverage, duplicates, flags, marts, overlap, reconcile
from fiscora.operators.geometry import problem

EVIDENCE = {"reason": "reviewed", "owner": "team", "evidence": "note.md", "checked_at": "2026-01-01T00:00:00Z"}


# ---- reconciliation --------------------------------------------------------------------------------------------


def table(spark, rows, schema="year int, amount double"):
    return spark.createDataFrame(rows, schema)


def test_reconciliation_1_duplicate_keys_fail_though_totals_agree(spark):
    r = reconcile.reconcile(table(spark, [(2023, 40.0), (2023, 60.0)]), table(spark, [(2023, 100.0)]), ["year"], "amount", "amount")
    assert not r.passed and r.facts["status_counts"] == {"MATCH": 1} and r.facts["input_quality"]["left"]["duplicate_key_rows"] == 2
    waived = reconcile.reconcile(table(spark, [(2023, 40.0), (2023, 60.0)]), table(spark, [(2023, 100.0)]), ["year"], "amount", "amount", duplicate_key_reason="monthly rows")
    assert waived.passed


def test_reconciliation_2_unique_match_passes(spark):
    r = reconcile.reconcile(table(spark, [(2023, 100.0)]), table(spark, [(2023, 100.0)]), ["year"], "amount", "amount")
    assert r.passed and r.exit_code == 0 and json.loads(r.summary())["passed"]


def test_reconciliation_statuses_and_tolerances(spark):
    left = table(spark, [(1, 100.0), (2, 104.0), (3, 200.0), (4, None), (5, 1.0), (7, 0.4)])
    right = table(spark, [(1, 100.4), (2, 100.0), (3, 100.0), (4, 1.0), (6, 1.0), (7, 0.0)])
    got = {r["year"]: r["status"] for r in reconcile.compare(left, right, ["year"], "amount", "amount").collect()}
    assert got == {1: "MATCH", 2: "MATCH", 3: "DISCREPANCY", 4: "DISCREPANCY", 5: "MISSING_RIGHT", 6: "MISSING_LEFT", 7: "MATCH"}
    r = reconcile.reconcile(left, right, ["year"], "amount", "amount", allow_status=("MISSING_LEFT", "MISSING_RIGHT"), null_value_reason="late data")
    assert [b for b in r.blockers if "MISSING" in b] == [] and "2 DISCREPANCY row(s)" in r.blockers


def test_reconciliation_null_keys_and_bad_values_are_never_waived(spark):
    left = table(spark, [(None, "1"), (1, "x"), (2, None)], "year int, amount string")
    right = table(spark, [(None, "1"), (1, "1"), (2, "1")], "year int, amount string")
    r = reconcile.reconcile(left, right, ["year"], "amount", "amount", duplicate_key_reason="r", null_value_reason="r")
    assert {"left has 1 null key rows", "left has 1 invalid value rows", "right has 1 null key rows"} == set(r.facts["quality_blockers"])
    with pytest.raises(ValueError):
        reconcile.reconcile(left, right, [], "amount", "amount")
    with pytest.raises(ValueError):
        reconcile.reconcile(left, right, ["gone"], "amount", "amount")


def test_reconciliation_counts_sum_to_rows(spark, sf_dir):
    from fiscora.plans.catalogue import QUERIES

    assert sum(r["n"] for r in QUERIES["reconcile_status_counts"](spark, sf_dir).collect()) == QUERIES["reconcile_status_detail"](spark, sf_dir).count()


# ---- flags -----------------------------------------------------------------------------------------------------

PREDICATE = {"description": "fund code", "branches": [{"all": [{"column": "funding_code", "operator": "starts_with", "value": "27"}]}]}


def flag_rows(spark, rows=((1, 2023, "10", "false", 100.0), (2, 2023, "27 A", "true", 50.0))):
    return spark.createDataFrame([tuple(r) for r in rows], "row_id int, year int, funding_code string, is_foreign string, approved double")


def test_flag_1_independent_predicate_passes(spark):
    r = flags.audit_flags(flag_rows(spark), ["approved"], ["row_id"], PREDICATE, require_both_values=True)
    assert r.passed, r.blockers
    assert [x["row_difference"] for x in r.facts["conservation"]] == [0]


def test_flag_2_predicate_on_the_flag_itself_fails(spark):
    own = {"description": "x", "branches": [{"all": [{"column": "is_foreign", "operator": "equals", "value": "true"}]}]}
    assert not flags.audit_flags(flag_rows(spark), ["approved"], ["row_id"], own).passed


def test_flag_without_predicate_never_passes(spark):
    assert flags.audit_flags(flag_rows(spark), ["approved"], ["row_id"]).blockers == ["an independent predicate is required for a passing audit"]


def test_flag_null_leaves_its_year_unpartitioned_even_where_allowed(spark):
    df = flag_rows(spark, [(1, 2023, "10", "false", 1.0), (2, 2023, "10", None, 5.0)])
    r = flags.audit_flags(df, ["approved"], ["row_id"], PREDICATE, allow_null_flag=True)
    assert r.blockers == ["year 2023 has 1 unpartitioned row(s)", "year 2023 approved does not conserve by 5.0"]
    lost = flags.audit_flags(flag_rows(spark, [(1, None, "10", None, 1.0)]), ["approved"], ["row_id"], PREDICATE, allow_null_flag=True)
    assert lost.blockers == ["1 row(s) have a null year"]


def test_flag_mismatch_ids_and_measures(spark):
    df = flag_rows(spark, [(1, 2023, "27", "false", None), (1, 2023, "10", "maybe", 1.0), (3, 2023, "10", "0", 1.0)])
    said = " ".join(flags.audit_flags(df, ["approved"], ["row_id"], PREDICATE).blockers)
    for part in ("1 row(s) have an invalid output flag", "2 row(s) have a duplicate stable id", "1 row(s) disagree", "1 row(s) have a null approved"):
        assert part in said
    expected = df.withColumn("expected", df.is_foreign)
    r = flags.audit_flags(expected, ["approved"], ["row_id"], PREDICATE, expected_column="expected")
    assert r.facts["provided_expected_predicate_mismatch_rows"] == 1
    with pytest.raises(ValueError):
        flags.audit_flags(df, ["approved"], ["row_id"], PREDICATE, expected_column="is_foreign")


# ---- overlap ---------------------------------------------------------------------------------------------------

CODES = [{"code": "A", "tag_kind": "primary", "econ": "Economic affairs"}, {"code": "B", "tag_kind": "primary", "econ": "Health"}]
CONFIG = {"country": "X", "expected_stages": ["Approved"], "minimum_rules_per_stage": 1, "expected_codes_by_stage": {"Approved": ["A"]}, "ranges": [{"name": "r", "measures": ["approved"], "measure_dispatch": ["approved"], "field_map": {"econ": "econ1", "year": "year"}}]}


def rule(code="A", criteria='[{"field":"econ","value":"A"}]', **more):
    return {"code": code, "row_type": "TAG", "sheet": "Approved", "measure": "approved", "criteria_json": criteria, **more}


def lines(spark, rows=((2023, 100.0, "A"),)):
    return {"r": spark.createDataFrame([tuple(r) for r in rows], "year int, approved double, econ1 string")}


def test_overlap_1_empty_rules_fail(spark):
    r = overlap.audit_overlaps(CONFIG, [], CODES, lines(spark))
    assert not r.passed and "lacks expected codes" in " ".join(r.blockers)


def test_overlap_2_clean_passes(spark):
    r = overlap.audit_overlaps(CONFIG, [rule()], CODES, lines(spark))
    assert r.passed, r.blockers
    assert r.facts["parser_coverage"][0]["matched_rows"] == 1


def test_overlap_3_repeated_branch_is_a_self_double(spark):
    r = overlap.audit_overlaps(CONFIG, [rule(criteria='[[{"field":"econ","value":"A"}],[{"field":"econ","value":"a"}]]')], CODES, lines(spark))
    assert not r.passed and r.facts["within_formula_self_doubles"][0]["approved_net_excess"] == 100.0


def test_overlap_pairs_and_net_excess(spark):
    config = CONFIG | {"expected_codes_by_stage": {"Approved": ["A", "B"]}}
    rows = [(2023, 100.0, "A"), (2024, 50.0, "A"), (None, 7.0, "A"), (2023, None, "A"), (2023, 5.0, "C")]
    r = overlap.audit_overlaps(config, [rule(), rule("B", '[{"field":"econ","op":"<>","value":"C"}]')], CODES, lines(spark, rows))
    (pair,) = r.facts["pairwise_overlaps"]
    assert (pair["rows"], pair["totals"]["approved"]["overlap"], pair["relationship"]) == (4, 157.0, "cross_category")
    assert [y["year"] for y in pair["by_year"]] == ["2023", "2024", None]
    assert {e["year"]: e["approved_net_excess"] for e in r.facts["dimension_year_net_excess"]} == {"2023": 100.0, "2024": 50.0}
    assert sum(p["totals"]["approved"]["overlap"] for p in r.facts["pairwise_overlaps"]) >= sum(e["approved_net_excess"] for e in r.facts["dimension_year_net_excess"])


def test_overlap_unsupported_rules_and_bad_configs(spark):
    r = overlap.audit_overlaps(CONFIG, [rule(criteria='[{"field":"gone","value":"A"}]'), rule(criteria="{")], CODES, lines(spark))
    assert [c["status"] for c in r.facts["unresolved_parser_coverage"]] == ["PARTIAL", "UNSUPPORTED"]
    for broken in ({"expected_stages": []}, {"expected_stages": ["a", "A"]}, {"expected_codes_by_stage": None}, {"minimum_rules_per_stage": 0}):
        with pytest.raises(ValueError):
            overlap.audit_overlaps(CONFIG | broken, [rule()], CODES, lines(spark))
    assert "repeats codes" in " ".join(overlap.audit_overlaps(CONFIG, [rule()], [*CODES, CODES[0]], lines(spark)).blockers)


def test_overlap_of_many_codes(spark):
    from pyspark.sql import functions as F

    df = spark.range(140).select(F.col("id").alias("i"), F.lit(1.0).alias("v"), F.lit(None).cast("int").alias("y"))
    codes = [{"code": f"C{k:03d}", "tag_kind": "k", "econ": "x"} for k in range(130)]
    masks = {c["code"]: (df.i == k) | (df.i == k + 1) for k, c in enumerate(codes)}
    met = overlap.memberships(df, masks, overlap.candidate_groups(codes), ["v"], "y")
    pairs = {(r["code_a"], r["code_b"]): r["rows"] for r in overlap.pair_overlaps(met, ["v"]).collect()}
    assert pairs == {(f"C{k:03d}", f"C{k + 1:03d}"): 1 for k in range(129)}
    assert {r["rows"] for r in overlap.code_totals(met, ["v"]).collect()} == {2} and overlap.net_excess(met, ["v"], True).count() == 0
    assert overlap.memberships(df, {}, {}, ["v"], None).count() == 0


def test_candidate_groups():
    groups = overlap.candidate_groups([{"code": "X_SBN_1", "tag_kind": "k", "econ": "a", "econ_sub": "b", "func": "c"}, {"code": "P", "econ": ""}])
    assert groups == {("subnational", "k", "econ_sub"): {"X_SBN_1": "b"}, ("subnational", "k", "func"): {"X_SBN_1": "c"}}


# ---- duplicates ------------------------------------------------------------------------------------------------


def sheet_config(**more):
    return {"name": "Raw", "role": "raw", "header_row": 1, "check_duplicate_headers": True, "check_exact_rows": True, "key_columns": ["row_id"]} | more


def audit_sheet(spark, rows, sheets=None, names=("Raw",), **config):
    df = spark.createDataFrame([(i + 2, *r) for i, r in enumerate(rows)], "row_number int, row_id int, amount double")
    whole = {"check_normalized_sheet_names": True, "sheets": sheets or [sheet_config()]} | config
    return duplicates.audit_workbook_duplicates(list(names), whole, lambda name, c: (df, "row_number", ["row_id", "amount"]))


def test_duplicates_1_uncovered_sheet_fails(spark):
    r = audit_sheet(spark, [(1, 10.0)], names=("Raw", "Other"))
    assert not r.passed and "missing from the audit contract: Other" in " ".join(r.blockers)
    assert audit_sheet(spark, [(1, 10.0)], names=("Raw", "Other"), excluded_sheets=[{"name": "Other", "role": "pivot", **EVIDENCE}]).passed


def test_duplicates_2_clean_passes_and_exact_rows_fail(spark):
    assert audit_sheet(spark, [(1, 10.0), (2, 20.0)]).passed
    r = audit_sheet(spark, [(1, 10.0), (1, 10.0)])
    assert "Raw: 1 exact duplicate row group(s)" in r.blockers and "Raw: 1 unexpected duplicate business-key group(s)" in r.blockers


def test_duplicates_3_evidenced_exception_passes(spark):
    allowed = [{"values": [1], **EVIDENCE}]
    assert audit_sheet(spark, [(1, 10.0), (1, 20.0)], [sheet_config(allowed_duplicate_keys=allowed)]).passed
    with pytest.raises(ValueError):
        audit_sheet(spark, [(1, 10.0)], [sheet_config(allowed_duplicate_keys=[{"values": [1], "reason": "x"}])])


def test_duplicates_incomplete_keys_and_blank_rows(spark):
    r = audit_sheet(spark, [(None, 10.0), (None, None)])
    assert r.blockers == ["Raw: 1 populated row(s) have incomplete business keys"] and r.facts["sheets"][0]["populated_data_rows"] == 1
    assert audit_sheet(spark, [(None, 10.0)], [sheet_config(require_complete_key=False)]).passed


def test_duplicates_columns_and_headers():
    assert duplicates.header_collisions(["A b", "a  B", "", None, "c"]) == {"a b": [0, 1]}
    assert duplicates.resolve_columns(["A", "x", "d"], ["a", "D", "d "], "key") == (["a"], ["key column not found: x", "key column is ambiguous: d"])
    assert "normalized sheet-name collision" in " ".join(duplicates.sheet_contract(["A", "a "], {"check_normalized_sheet_names": True, "sheets": [sheet_config(name="A"), sheet_config(name="a ")]}))


def test_duplicate_members(spark):
    df = spark.createDataFrame([(1, "a"), (2, "A "), (3, "b")], "i int, t string")
    assert [r["i"] for r in duplicates.duplicate_members(df, ["t"], "i", fold_text=True).orderBy("i").collect()] == [1, 2]


# ---- coverage --------------------------------------------------------------------------------------------------


def contract(**dataset):
    base = {"name": "population", "role": "population", "path": "p.csv", "name_column": "region", "year_column": "year", "value_column": "population", "required_complete": True, "required_years": [2023]}
    return {
        "country": "X", "iso3": "XXX", "subnational_required": True, "required_dataset_names": ["population"],
        "target": {"admin_level": "ADM1", "vintage": "2020", "boundary_path": "b.geojson", "boundary_name_property": "n", "expected_unit_count": 2, "require_geometry_validation": True}, "datasets": [base | dataset],
    }


POINT = '{"type":"Point","coordinates":[0,0]}'


def cover(spark, spec, rows=(("North", 2023, 10.0),), names=("North", "Central"), geometry=POINT):
    df = spark.createDataFrame([tuple(r) for r in rows], "region string, year int, population double")
    units = spark.createDataFrame([(n, geometry) for n in names], "name string, geometry string")
    return coverage.audit_coverage(spec, units, {"population": df})


def test_coverage_1_empty_datasets_fail(spark):
    assert not cover(spark, contract() | {"datasets": []}).passed


def test_coverage_2_unreviewed_gap_fails(spark):
    r = cover(spark, contract(accepted_no_data=[{"target": "Central", "reason": "none"}]))
    said = " ".join(r.blockers)
    assert all(f"accepted_no_data[0].{f}: " in said for f in ("owner", "evidence", "checked_at"))


def test_coverage_3_reviewed_gap_passes(spark):
    r = cover(spark, contract(accepted_no_data=[{"target": "Central", **EVIDENCE}]))
    assert r.passed, r.blockers


def test_coverage_mapping_gaps_and_values(spark):
    swap = {"North": "Central", "Central": "North"}
    r = cover(spark, contract(mapping=swap), [("North", 2023, 1.0), ("Central", 2023, 2.0)])
    assert r.passed and r.facts["datasets"][0]["mapped_target_count"] == 2
    rows = [("North", 2023, -1.0), ("N.", 2023, None), ("", 2022, 3.0), ("Nowhere", 2023, 1.0)]
    said = " ".join(cover(spark, contract(mapping={"N.": "North", "gone": "Lost"}), rows).blockers)
    for part in ("1 source name(s) that lead to no target unit: ['Nowhere']", "1 mapping target(s) that are no target unit: ['Lost']", "1 row(s) without a source name", "1 row(s) without a value", "1 row(s) with a value below zero", "2 row(s) that share a target key", "1 target unit(s) that several source names lead to: ['North']", "1 target unit(s) without a row: ['Central']", "1 required year(s) that target units lack: [(2023, 'Central')]"):
        assert part in said, part
    summed = cover(spark, contract(mapping={"N.": "North"}, aggregation="sum", allow_negative=True), [("North", 2023, -1.0), ("N.", 2023, 1.0), ("Central", 2023, 1.0)])
    assert summed.passed, summed.blockers


def test_coverage_boundaries_and_load_errors(spark):
    said = " ".join(cover(spark, contract(), names=("North", "North", ""), geometry=None).blockers)
    for part in ("1 boundary(s) with a blank name", "1 boundary(s) with a repeated name: ['North']", "1 target unit(s) instead of 2", "3 boundary(s) with a missing geometry"):
        assert part in said
    failed = coverage.audit_coverage(contract(), None, {"population": OSError("gone")}, boundary_error="no file")
    assert "the boundaries were not read: no file" in failed.blockers and "population: the data were not read: gone" in failed.blockers
    units = spark.createDataFrame([("North", None)], "name string, geometry string")
    table_only = coverage.audit_coverage(contract(), units, {}, has_geometry=False)
    assert "geometries were not looked at: a table of boundaries has none" in table_only.blockers


def test_coverage_lists_say_where_they_are_cut(spark):
    """Counts and tables hold everything; a report lists the first and says so."""
    rows = [(f"stray{i:03d}", 2023, 1.0) for i in range(30)] + [("North", 2023, 1.0)]
    df = spark.createDataFrame(rows, "region string, year int, population double")
    units = spark.createDataFrame([(n, POINT) for n in ("North", *(f"unit{i:03d}" for i in range(30)))], "name string, geometry string")
    r = coverage.audit_coverage(contract(required_years=[2023, 2024]), units, {"population": df}, most=10)
    said = r.facts["datasets"][0]
    assert said["counts"] == {"stray_name": 30, "no_data": 30, "year_gap": 61} and len(said["unmatched_mapped_names"]) == 10 == len(said["target_without_any_data"])
    assert said["truncated_lists"] == ["no_data", "stray_name", "year_gap", "target_without_any_data"] and "['stray000'" in " ".join(r.blockers) and "and more" in " ".join(r.blockers)
    assert r.tables["population/findings"].count() == 121 and r.facts["target"]["units_truncated"]
    whole = coverage.audit_coverage(contract(), units, {"population": df}).facts["datasets"][0]
    assert len(whole["unmatched_mapped_names"]) == 30 and whole["truncated_lists"] == []


def test_coverage_contract_issues(spark):
    bare = lambda spec: " ".join(coverage.audit_coverage(spec, None, {}).blockers)
    for change, said in (
        ({"country": " "}, "country: text is wanted"), ({"subnational_required": False}, "subnational_required: true is wanted"), ({"required_dataset_names": []}, "required_dataset_names: a list of 1 or more"), ({"required_dataset_names": ["a", "a"]}, "required_dataset_names: 'a' stands 2 times"),
        ({"required_dataset_names": ["other"]}, "datasets: other is required and not there"), ({"target": None}, "target: an object is wanted"), ({"datasets": [{"name": "x"}]}, "dataset x.role: text is wanted"),
    ):
        assert said in bare(contract() | change), said
    target = contract()["target"]
    for count, said in ((None, "a whole number"), ("x", "a whole number"), (0, "one or more is wanted"), ("2", "0 target unit(s) instead of 2")):
        assert said in bare(contract() | {"target": target | {"expected_unit_count": count}})
    assert "required_complete: true is wanted" in bare(contract(required_complete=False))
    assert "accepted_no_data: 'Central' stands 2 times" in " ".join(cover(spark, contract(accepted_no_data=[{"target": "Central", **EVIDENCE}] * 2)).blockers)
    assert "1 accepted gap(s) that are no target unit: ['Mars']" in " ".join(cover(spark, contract(accepted_no_data=[{"target": "Mars", **EVIDENCE}])).blockers)

SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]


@pytest.mark.parametrize(
    "geometry, ok",
    [
        ({"type": "Polygon", "coordinates": [SQUARE]}, True), ({"type": "Polygon", "coordinates": [[[0, 0], [4, 4], [4, 0], [0, 4], [0, 0]]]}, False), ({"type": "Polygon", "coordinates": [SQUARE[:-1]]}, False),
        ({"type": "Polygon", "coordinates": [SQUARE, [[1, 1], [2, 1], [2, 2], [1, 1]]]}, True), ({"type": "Polygon", "coordinates": [SQUARE, [[9, 9], [10, 9], [10, 10], [9, 9]]]}, False),
        ({"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [2, 2], [0, 0]]]}, False), ({"type": "Polygon", "coordinates": []}, False), ({"type": "Blob", "coordinates": [1]}, False), ({"type": "Point"}, False),
        ({"type": "MultiPolygon", "coordinates": [[SQUARE], [[[9, 9], [10, 9], [10, 10], [9, 9]]]]}, True), ({"type": "LineString", "coordinates": [[0, 0], [0, 0]]}, False), ("{", False),
        ({"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [0, 0]}]}, True), ({"type": "Point", "coordinates": [0, float("inf")]}, False),
        ({"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [2, 0], [2, 3], [0, 0]]]}, False),
    ],
)
def test_geometry(geometry, ok):
    assert (problem(geometry) is None) is ok


# ---- marts -----------------------------------------------------------------------------------------------------


def test_layers_and_population(spark):
    df = spark.createDataFrame([("N", 2023, 5.0), ("C", 2023, 6.0), ("N", 2024, None)], "region string, year int, people double")
    layers = marts.layer_conservation([("raw", df), ("bronze", df), ("gold", df.filter("people > 5"))], "people")
    assert marts.first_loss(layers) == "gold"
    issues = marts.population_problems(df, "region", "year", "people", [2023, 2024, 2025], 2, {2023: 12.0})
    assert issues == ["1 rows of null population", "year 2023 does not add up to its published total", "year 2024 has 1 units, not 2", "year 2025 is missing"]


def test_registry(spark):
    a = spark.createDataFrame([(2023, 1.0), (2024, 1.0)], "year int, amount double")
    aggregate = marts.union_countries({"A": a.filter("year = 2023")})
    assert marts.registry_problems({"A": a}, aggregate, ["A"]) == ["aggregate lost years of A: [2024]"]
    assert marts.registry_problems({"A": a}, marts.union_countries({"A": a}), ["A", "A"]) == ["country registered 2 times: A"]


def test_report_is_written(spark, tmp_path):
    r = reconcile.reconcile(table(spark, [(1, 1.0)]), table(spark, [(1, 3.0)]), ["year"], "amount", "amount")
    said = json.loads(r.write(tmp_path / "deep" / "report.json").read_text())
    assert said["check"] == "reconciliation" and said["passed"] is False and said["blocking_sample"][0]["status"] == "DISCREPANCY"
    r.write_table("detail", str(tmp_path / "detail"))
    assert spark.read.option("header", True).csv(str(tmp_path / "detail")).count() == 1


def test_stream_of_batches(spark, tmp_path):
    from fiscora.streaming.row_checks import reconcile_stream

    table(spark, [(1, 1.0), (2, 9.0)]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("year int, amount double").parquet(str(tmp_path / "in"))
    reconcile_stream(stream, table(spark, [(1, 1.0), (2, 2.0), (3, 3.0)]), ["year"], "amount", "amount", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert [r["year"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [2]
