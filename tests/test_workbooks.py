"""Workbooks made with zipfile: reading, inventory, patches, verification; and table scans."""

from __future__ import annotations

import json
import zipfile
from xml.sax.saxutils import escape

import pytest

from fiscora.operators import duplicates, workbook
from fiscora.sources import ooxml, tables

MAIN, REL, PKG = ooxml.MAIN, ooxml.DOC_REL, ooxml.PKG_REL


def cell(ref, value=None, formula=None, kind=None, style=None):
    attrs = "".join(f' {k}="{v}"' for k, v in (("t", kind), ("s", style)) if v is not None)
    inside = (f"<f>{escape(formula)}</f>" if formula is not None else "") + (f"<v>{escape(str(value))}</v>" if value is not None and kind != "inlineStr" else "")
    if kind == "inlineStr":
        inside += f"<is><t>{escape(value)}</t></is>"
    return f'<c r="{ref}"{attrs}>{inside}</c>'


def make(path, sheets, strings=(), names="", chain=False):
    """sheets: name to cell texts; a name may come with a state."""
    rels, listed = "", ""
    with zipfile.ZipFile(path, "w") as z:
        for i, (name, cells) in enumerate(sheets.items(), 1):
            name, _, state = name.partition("|")
            listed += f'<sheet name="{name}" sheetId="{i}" r:id="rId{i}"' + (f' state="{state}"' if state else "") + "/>"
            rels += f'<Relationship Id="rId{i}" Type="x/worksheet" Target="{"/xl/" if i % 2 else ""}worksheets/sheet{i}.xml"/>'
            if cells is not None:
                rows = "".join(cells)
                z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{MAIN}"><sheetData><row>{rows}</row></sheetData></worksheet>')
        if chain:
            rels += '<Relationship Id="rId99" Type="x/calcChain" Target="calcChain.xml"/>'
            z.writestr("xl/calcChain.xml", "<calcChain/>")
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{listed}</sheets>{names}</workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PKG}">{rels}</Relationships>')
        z.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Override PartName="/xl/calcChain.xml" ContentType="x"/></Types>')
        if strings:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">' + "".join(f"<si><r><t>{escape(s[:1])}</t></r><r><t>{escape(s[1:])}</t></r></si>" for s in strings) + "</sst>")
    return str(path)


@pytest.fixture
def book(tmp_path):
    raw = [cell("A1", 0, kind="s"), cell("B1", "amount", kind="inlineStr"), cell("A2", 1), cell("B2", "10"), cell("A3", 2), cell("B3", 20), cell("C9", 1, kind="b"), '<c r="bad1x"/>']
    out = [cell("A1", 30, "SUM(Raw!B2:B3)", style="4"), cell("B1", 2, "OFFSET(A1,0,0)+STDEV.S(A1)"), cell("C1", 7), cell("A2", "#REF!", "A9", kind="e"), cell("A3", None, "1+1")]
    names = '<definedNames><definedName name="ok">Raw!$A$1</definedName><definedName name="gone" hidden="1" localSheetId="0">#REF!</definedName></definedNames>'
    return make(tmp_path / "book.xlsx", {"Raw": raw, "Out|hidden": out, "Lost": None}, ["row_id"], names, chain=True)


def test_cells(spark, book):
    cells = {(r["sheet"], r["ref"]): r for r in ooxml.read_cells(spark, book).collect()}
    assert cells["Raw", "A1"]["value"] == "row_id" and cells["Raw", "B1"]["value"] == "amount" and cells["Raw", "C9"]["value"] == "true"
    assert cells["Out", "A1"]["formula"] == "SUM(Raw!B2:B3)" and cells["Out", "A1"]["state"] == "hidden" and cells["Out", "A3"]["value"] is None
    assert cells["Raw", "C9"]["col_num"] == 3 and ("Raw", "bad1x") not in cells
    with zipfile.ZipFile(book) as z:
        assert "worksheet target missing" in ooxml.sheets_of(z)[2]["error"]


def test_inventory(spark, book):
    r = workbook.audit_workbook(spark, book)
    assert r.blockers == ["1 formula cell(s) have no cached value", "1 cell(s) hold errors"]
    out = {s["name"]: s for s in r.facts["sheets"]}["Out"]
    assert out["formula_count"] == 4 and out["functions"] == {"OFFSET": 1, "S": 1, "SUM": 1}
    assert [c["ref"] for c in out["volatile_cells"]["rows"]] == ["B1"] and [c["ref"] for c in out["hardcoded_cells"]["rows"]] == ["C1"]
    assert r.facts["broken_defined_name_count"] == 1 and not r.facts["macro_enabled"]
    assert {x["sheet"]: x["hardcoded_suspect_count"] for x in workbook.sheet_table(r.tables).collect()} == {"Raw": 0, "Out": 1}
    cut = {s["name"]: s for s in workbook.audit_workbook(spark, book, limit=0).facts["sheets"]}["Out"]
    assert cut["errors_cells"] == {"rows": [], "truncated": True}


def test_inventory_values_only_passes(spark, tmp_path):
    assert workbook.audit_workbook(spark, make(tmp_path / "v.xlsx", {"S": [cell("A1", 2)]})).passed
    missing = workbook.audit_workbook(spark, make(tmp_path / "m.xlsx", {"S": [cell("A1", None, "1+1")]}))
    assert not missing.passed and missing.facts["formula_without_cached_value_count"] == 1
    with pytest.raises(ValueError):
        workbook.audit_workbook(spark, str(tmp_path / "x.csv"))


PATCH = {"sheet": "Out", "cell": "A3", "old_formula": "1+1", "new_formula": "=2+2", "expected_after": 4, "reason": "test"}


def test_patch_and_verify(spark, book, tmp_path):
    out = str(tmp_path / "new.xlsx")
    assert workbook.patch_workbook(book, [PATCH], out)["patched_formulas"] == 1
    r = workbook.verify_patch(spark, book, out, [PATCH])
    assert r.passed, r.blockers
    assert "xl/calcChain.xml" in r.facts["changed_archive_members"]
    cells = {c["ref"]: c for c in ooxml.read_cells(spark, out, "Out").collect()}
    assert cells["A3"]["formula"] == "2+2" and cells["A3"]["cached"] == "4"


def test_patch_refuses(book, tmp_path):
    out = str(tmp_path / "new.xlsx")
    for bad in ({"old_formula": "=9"}, {"cell": "Z9"}, {"cell": "a1"}, {"sheet": "Nope"}, {"new_formula": ""}, {"old_formula": None}):
        with pytest.raises(ValueError):
            workbook.patch_workbook(book, [PATCH | bad], out)
    for patches in ([], [PATCH, PATCH], [{"sheet": "Out"}], "x"):
        with pytest.raises(ValueError):
            workbook.patch_workbook(book, patches, out)
    with pytest.raises(ValueError):
        workbook.patch_workbook(book, [PATCH], book)
    workbook.patch_workbook(book, [PATCH | {"old_formula": "=9"}], out, any_old=True)


def test_verify_finds_other_changes(spark, book, tmp_path):
    out = str(tmp_path / "new.xlsx")
    workbook.patch_workbook(book, [PATCH, PATCH | {"cell": "A1", "old_formula": "SUM(Raw!B2:B3)"}], out)
    r = workbook.verify_patch(spark, book, out, [PATCH])
    assert r.facts["unexpected_changed_cells"] == ["Out!A1"]
    same = workbook.verify_patch(spark, book, book, [PATCH])
    assert "the workbook does not ask to be calculated anew in full" in same.blockers and "member xl/calcChain.xml: left in the archive" in same.blockers
    assert "1 cell(s): has another formula: ['Out!A3']" in same.blockers
    other = workbook.verify_patch(spark, book, out, [PATCH | {"old_formula": "=7"}, PATCH | {"cell": "Z9"}])
    assert other.facts["cell_reasons"] == {"had another formula": 1, "no such cell": 1, "not in the patch": 1}


def test_sheet_as_table_and_its_duplicates(spark, book, tmp_path):
    df, labels = ooxml.read_sheet(spark, book, "Raw", max_data_row=3)
    assert labels == ["row_id", "amount"] and [tuple(r) for r in df.orderBy("row_number").collect()] == [(2, "1", "10"), (3, "2", "20")]
    assert tables.read_table(spark, book, sheet="Raw").filter("row_id is not null").count() == 2
    twice = make(tmp_path / "d.xlsx", {"Raw": [cell("A1", "row_id", kind="inlineStr"), cell("B1", "Row_ID ", kind="inlineStr"), cell("A2", 1), cell("B2", 1), cell("A3", 1), cell("B3", 1)]})
    config = {"check_normalized_sheet_names": True, "sheets": [{"name": "Raw", "role": "other", "check_duplicate_headers": True, "check_exact_rows": True}]}

    def read(name, c):
        rows, found = ooxml.read_sheet(spark, twice, name)
        return rows, "row_number", found

    r = duplicates.audit_workbook_duplicates(["Raw"], config, read)
    assert "Raw: 1 duplicate header group(s)" in r.blockers and "Raw: 1 exact duplicate row group(s)" in r.blockers
    with pytest.raises(ValueError):
        ooxml.read_sheet(spark, book, "Raw", header_row=0)


def keyed_book(path, *values, styles=None):
    """A sheet row_id, amount: the row ids are (value, kind, style) and amounts differ."""
    cells = [cell("A1", "row_id", kind="inlineStr"), cell("B1", "amount", kind="inlineStr")]
    for i, (value, kind, style) in enumerate(values, 2):
        cells += [cell(f"A{i}", value, kind=kind, style=style), cell(f"B{i}", 10 * i)]
    made = make(path, {"Raw": cells})
    if styles:
        with zipfile.ZipFile(made, "a") as z:
            z.writestr("xl/styles.xml", styles)
    return made


def run_duplicates(path, tmp_path, **sheet):
    from fiscora import cli

    whole = {"name": "Raw", "role": "raw", "check_duplicate_headers": True, "check_exact_rows": True, "key_columns": ["row_id"]} | sheet
    (tmp_path / "config.json").write_text(json.dumps({"check_normalized_sheet_names": True, "sheets": [whole]}))
    code = cli.main(["duplicates", "--workbook", path, "--config", str(tmp_path / "config.json"), "--report", str(tmp_path / "report.json")])
    return code, json.loads((tmp_path / "report.json").read_text())["blockers"]


REVIEWED = {"reason": "r", "owner": "o", "evidence": "e", "checked_at": "2026-01-01T00:00:00Z"}


def test_reviewed_exception_on_a_workbook(spark, tmp_path):
    """The key is a number in the sheet and in the exception."""
    path = keyed_book(tmp_path / "k.xlsx", (1, None, None), (1, None, None))
    assert run_duplicates(path, tmp_path) == (1, ["Raw: 1 unexpected duplicate business-key group(s)"])
    assert run_duplicates(path, tmp_path, allowed_duplicate_keys=[{"values": [1], **REVIEWED}]) == (0, [])
    assert run_duplicates(path, tmp_path, allowed_duplicate_keys=[{"values": ["1"], **REVIEWED}])[0] == 1


def test_typed_keys_of_a_workbook(spark, tmp_path):
    repeated = lambda *values, **more: run_duplicates(keyed_book(tmp_path / "t.xlsx", *values, **more), tmp_path)[0] == 1
    assert not repeated((1, None, None), ("1", "inlineStr", None))  # a number is no text
    assert repeated((1, None, None), ("1.0", "n", None)) and repeated(("1e2", None, None), (100, "n", None))
    assert not repeated((1, "b", None), (1, None, None)) and repeated((1, "b", None), (1, "b", None))
    styles = f'<styleSheet xmlns="{MAIN}"><numFmts><numFmt numFmtId="164" formatCode="[Red]dd/mm/yyyy"/><numFmt numFmtId="165" formatCode="0.0&quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>'
    assert not repeated((45292, None, "1"), (45292, None, "0"), styles=styles) and repeated((45292, None, "1"), (45292, None, "2"), styles=styles)
    assert repeated((45292, None, "3"), (45292, None, "0"), styles=styles) and repeated((45292, None, "1"), ("2024-01-01T00:00:00", "d", None), styles=styles)
    rows, _ = ooxml.read_sheet(spark, keyed_book(tmp_path / "t.xlsx", (45292.5, None, "1"), (" ", "inlineStr", None), (True, "b", None), ("#N/A", "e", None), styles=styles), "Raw", typed=True)
    seen = {r["row_number"]: tuple(r["row_id"]) for r in rows.collect()}
    assert seen == {2: ("date", "2024-01-01T12:00:00"), 3: ("blank", None), 4: ("bool", "false"), 5: ("text", "#N/A")}
    assert ooxml.serial_moment("1", False) == "1900-01-01T00:00:00" and ooxml.serial_moment("61", False) == "1900-03-01T00:00:00" and ooxml.serial_moment("0", True) == "1904-01-01T00:00:00"
    assert ooxml.serial_moment("x", False) is None and ooxml.serial_moment("1e300", False) is None


def test_corrupt_member(tmp_path, book):
    data = bytearray(open(book, "rb").read())
    at = data.find(b"sheetData")
    data[at] ^= 0xFF
    bad = tmp_path / "bad.xlsx"
    bad.write_bytes(data)
    with pytest.raises(Exception):
        ooxml.check_archive(str(bad))


def test_table_scans(spark, tmp_path):
    csv = tmp_path / "t.csv"
    csv.write_text("code,amount,note\n007,1.5,NA\n010,2,x\n")
    df = tables.read_table(spark, str(csv), text_columns=("code",))
    assert [tuple(r) for r in df.orderBy("code").collect()] == [("007", 1.5, None), ("010", 2.0, "x")]
    rules = tmp_path / "rules.csv"
    rules.write_bytes("﻿code,note\n01,\n".encode())
    assert tables.records(spark, str(rules)) == [{"code": "01", "note": ""}]
    df.write.parquet(str(tmp_path / "t.parquet"))
    assert tables.read_table(spark, str(tmp_path / "t.parquet")).count() == 2
    for bad, more in (("x.txt", {}), ("x.xlsx", {"require_sheet": True})):
        with pytest.raises(ValueError):
            tables.read_table(spark, bad, **more)


def test_boundaries(spark, tmp_path):
    geo = tmp_path / "b.geojson"
    features = [{"type": "Feature", "properties": {"n": " North "}, "geometry": {"type": "Point", "coordinates": [0, 0]}}, {"type": "Feature", "properties": {}, "geometry": None}]
    geo.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    df, has = tables.read_boundaries(spark, str(geo), "n")
    rows = sorted((r["name"], r["geometry"] is not None) for r in df.collect())
    assert has and rows == [("", False), ("North", True)]
    (tmp_path / "b.csv").write_text("n\nNorth\n")
    df, has = tables.read_boundaries(spark, str(tmp_path / "b.csv"), "n")
    assert not has and df.first()["name"] == "North"
    with pytest.raises(ValueError):
        tables.read_boundaries(spark, str(tmp_path / "b.csv"), "gone")
