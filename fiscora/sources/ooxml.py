"""OOXML workbooks as tables of cells (S08-S16): a Python data source with one partition for each sheet.

Cells are parsed as a stream and given out as they come, so a sheet of any length takes little memory.
"""

from __future__ import annotations

import datetime as dt
import posixpath
import re
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Namespaces of the format, and the members every workbook has.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
DOC_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PKG_REL = "http://schemas.openxmlformats.org/package/2006/relationships"
WORKBOOK, RELS, STRINGS, TYPES, STYLES = "xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/sharedStrings.xml", "[Content_Types].xml", "xl/styles.xml"
CELLS = (
    "sheet_pos int, sheet string, state string, ref string, col string, col_num int, row int, cell_type string, style string, has_formula boolean, formula string, cached string, value string, kind string"
)
#: Number formats of the standard that show dates or times.
DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))
_REF = re.compile(r"([A-Z]+)([0-9]+)")


@contextmanager
def open_archive(path: str) -> Iterator[zipfile.ZipFile]:
    """A workbook at a path of this machine, or at the URI of a store that every executor can open."""
    if "://" not in path or path.startswith("file://"):
        with zipfile.ZipFile(path.removeprefix("file://")) as archive:
            yield archive
        return
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    with store.open_input_file(place) as stream, zipfile.ZipFile(stream) as archive:
        yield archive


def tag(name: str, space: str = MAIN) -> str:
    return f"{{{space}}}{name}"


def target_member(target: str, base: str = WORKBOOK) -> str:
    """Absolute from the archive's root, else relative to the base's folder."""
    return target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(posixpath.dirname(base), target))


def relations(xml: bytes) -> dict[str, str]:
    return {r.get("Id"): target_member(r.get("Target", "")) for r in ET.fromstring(xml).iter(tag("Relationship", PKG_REL))}


def sheets_of(archive: zipfile.ZipFile) -> list[dict]:
    """Position, name, state, member, and an error where the member is missing."""
    members = set(archive.namelist())
    rels = relations(archive.read(RELS)) if RELS in members else {}
    out = []
    for i, s in enumerate(ET.fromstring(archive.read(WORKBOOK)).iterfind(f"{tag('sheets')}/{tag('sheet')}"), 1):
        member = rels.get(s.get(tag("id", DOC_REL)))
        found = {"position": i, "name": s.get("name"), "state": s.get("state", "visible"), "member": member}
        out.append(found if member in members else found | {"error": f"worksheet target missing: {member}"})
    return out


def shared_strings(archive: zipfile.ZipFile) -> list[str]:
    """Of each item all its text runs."""
    if STRINGS not in archive.namelist():
        return []
    return ["".join(t.text or "" for t in item.iter(tag("t"))) for item in ET.fromstring(archive.read(STRINGS))]


def check_archive(path: str) -> None:
    """Raises where a member fails its checksum."""
    with open_archive(path) as archive:
        if bad := archive.testzip():
            raise ValueError(f"corrupt workbook member in {path}: {bad}")


def decode(cell: ET.Element, strings: list[str]) -> str | None:
    """The value as text; booleans are true and false."""
    kind, raw = cell.get("t"), cell.find(tag("v"))
    if kind == "inlineStr":
        inline = cell.find(tag("is"))
        return "" if inline is None else "".join(t.text or "" for t in inline.iter(tag("t")))
    if raw is None or raw.text is None:
        return None
    if kind == "s":
        return strings[int(raw.text)] if raw.text.isdigit() and int(raw.text) < len(strings) else raw.text
    return {"1": "true"}.get(raw.text, "false") if kind == "b" else raw.text


def date_styles(archive: zipfile.ZipFile) -> frozenset[str]:
    """The cell styles (by their index, as cells name them) whose number format is a date or a time."""
    if STYLES not in archive.namelist():
        return frozenset()
    root = ET.fromstring(archive.read(STYLES))
    own = {}
    for f in root.iterfind(f"{tag('numFmts')}/{tag('numFmt')}"):
        shown = re.sub(r'"[^"]*"|\\\\.|\[[^\]]*\]', "", f.get("formatCode", ""))  # without quoted text, escapes and colours
        own[f.get("numFmtId")] = bool(re.search("[dmyhs]", shown, re.I)) and "General" not in shown
    formats = [x.get("numFmtId", "0") for x in root.iterfind(f"{tag('cellXfs')}/{tag('xf')}")]
    return frozenset(str(i) for i, f in enumerate(formats) if own.get(f, f.isdigit() and int(f) in DATE_FORMATS))


def starts_1904(archive: zipfile.ZipFile) -> bool:
    properties_ = ET.fromstring(archive.read(WORKBOOK)).find(tag("workbookPr"))
    return properties_ is not None and properties_.get("date1904") in ("1", "true")


def serial_moment(serial: str, from_1904: bool) -> str | None:
    """A date's serial number as ISO text to the second; the sheet's 29 February 1900, which never was, counts as 60."""
    try:
        days = float(serial)
        start = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 31) if days < 60 else dt.datetime(1899, 12, 30)
        return (start + dt.timedelta(seconds=round(days * 86400))).isoformat(timespec="seconds")
    except (ValueError, OverflowError):
        return None


def kind_of(cell: ET.Element, shown: str | None, dates: frozenset[str]) -> str:
    """Text, number, bool, date or blank; a formula stands as its text."""
    if cell.find(tag("f")) is not None:
        return "text"
    if shown is None or not shown.strip():
        return "blank"
    said = cell.get("t") or "n"
    return {"b": "bool", "d": "date", "n": "date" if cell.get("s") in dates else "number"}.get(said, "text")


def cells_of(path: str, sheet: dict) -> Iterator[tuple]:
    """The cells of a sheet; references that are none are skipped.  Rows are dropped from the tree as they are read."""
    with open_archive(path) as archive:
        strings, dates, from_1904 = shared_strings(archive), date_styles(archive), starts_1904(archive)
        with archive.open(sheet["member"]) as stream:
            rows = None
            for event, el in ET.iterparse(stream, ("start", "end")):
                if event == "start":
                    rows = el if el.tag == tag("sheetData") else rows
                    continue
                if el.tag == tag("row") and rows is not None:
                    rows.clear()
                if el.tag != tag("c"):
                    continue
                if m := _REF.fullmatch(el.get("r", "")):
                    letters, number = m.groups()
                    column = 0
                    for ch in letters:
                        column = column * 26 + ord(ch) - 64
                    f, raw, shown = el.find(tag("f")), el.find(tag("v")), decode(el, strings)
                    kind = kind_of(el, shown, dates)
                    if kind == "date" and el.get("t") != "d":
                        moment = serial_moment(shown, from_1904)
                        shown, kind = (shown, "number") if moment is None else (moment, kind)
                    yield (
                        sheet["position"], sheet["name"], sheet["state"], m.group(), letters, column, int(number), el.get("t"), el.get("s"), f is not None,
                        None if f is None else f.text or "", None if raw is None else raw.text, shown, kind,
                    )
                el.clear()


class SheetPartition(InputPartition):
    def __init__(self, sheet: dict):
        self.sheet = sheet


class CellReader(DataSourceReader):
    def __init__(self, path: str, only: str | None):
        self.path, self.only = path, only

    def partitions(self) -> list[SheetPartition]:
        with open_archive(self.path) as archive:
            return [SheetPartition(s) for s in sheets_of(archive) if "error" not in s and self.only in (None, s["name"])]

    def read(self, partition: SheetPartition) -> Iterator[tuple]:
        if partition is not None:
            yield from cells_of(self.path, partition.sheet)


class WorkbookSource(DataSource):
    """spark.read.format("workbook_cells").option("path", ...), of a path or URI that every executor can open."""

    @classmethod
    def name(cls) -> str:
        return "workbook_cells"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> CellReader:
        return CellReader(self.options["path"], self.options.get("sheet"))


def read_cells(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    spark.dataSource.register(WorkbookSource)
    reader = spark.read.format("workbook_cells").option("path", path)
    return (reader.option("sheet", sheet) if sheet else reader).load()


def sheet_names(path: str) -> list[str]:
    with open_archive(path) as archive:
        return [s["name"] for s in sheets_of(archive)]


def defined_names(path: str) -> list[dict]:
    """S13."""
    with open_archive(path) as archive:
        root = ET.fromstring(archive.read(WORKBOOK))
    out = []
    for n in root.iterfind(f"{tag('definedNames')}/{tag('definedName')}"):
        refers = n.text or ""
        out.append({"name": n.get("name"), "local_sheet_id": n.get("localSheetId"), "hidden": n.get("hidden") == "1", "refers_to": refers, "broken": "#REF!" in refers})
    return out


def properties(path: str) -> dict:
    """Calculation settings, macros, members of external links."""
    with open_archive(path) as archive:
        calc = ET.fromstring(archive.read(WORKBOOK)).find(tag("calcPr"))
        members = archive.namelist()
    links = sorted(m for m in members if re.fullmatch(r"xl/externalLinks/externalLink\d+\.xml", m))
    return {"calculation": {} if calc is None else dict(calc.attrib), "macro_enabled": "xl/vbaProject.bin" in members, "external_link_members": links}


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None, header_row: int = 1, data_start_row: int | None = None, max_data_row: int | None = None, row_column: str = "row_number", typed: bool = False) -> tuple[DataFrame, list[str]]:
    """A sheet's rows by header, with their numbers; formulas stand as their text, not their value.

    Columns are text, or with `typed` struct(kind, value), where numbers of equal value have one text.  Labels that repeat
    get their column's letters.  Returns the rows and the labels as they are.
    """
    name = sheet or sheet_names(path)[0]
    start = data_start_row or header_row + 1
    if header_row < 1 or start <= header_row:
        raise ValueError(f"{name}: header_row must be positive and data_start_row must follow it")
    cells = read_cells(spark, path, name)
    shown = F.when(F.col("has_formula"), F.concat(F.lit("="), F.coalesce("formula", F.lit("")))).otherwise(F.col("value"))
    head = cells.filter(F.col("row") == header_row).select("col", "col_num", shown.alias("label")).orderBy("col_num").collect()
    head = [h for h in head if h["label"] is not None and h["label"].strip()]
    labels = [h["label"] for h in head]
    if not head:
        return spark.createDataFrame([], f"`{row_column}` int"), []
    inside = (F.col("row") >= start) if max_data_row is None else (F.col("row") >= start) & (F.col("row") <= max_data_row)
    if typed:
        number = F.when(F.col("kind") == "number", (shown.try_cast("double") + F.lit(0.0)).cast("string"))
        held = F.struct(F.coalesce("kind", F.lit("blank")).alias("kind"), F.when(F.col("kind") != "blank", F.coalesce(number, shown)).alias("value"))
        blank = F.struct(F.lit("blank").alias("kind"), F.lit(None).cast("string").alias("value"))
    else:
        held, blank = shown, F.lit(None).cast("string")
    columns = [F.coalesce(F.max(F.when(F.col("col_num") == h["col_num"], held)), blank).alias(h["label"] if labels.count(h["label"]) == 1 else f"{h['label']} ({h['col']})") for h in head]
    return cells.filter(inside).groupBy(F.col("row").alias(row_column)).agg(*columns), labels
