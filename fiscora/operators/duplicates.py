"""Duplicate rows and business keys over any DataFrame, and the sheet contract of a workbook (C05; G18-G20, P01-P03)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import cell_key, normalize_text, normalized_text, timestamp_ok
from ..report import Report

ROLES = frozenset(("formula_output", "lookup", "raw", "supplemental", "pivot", "other"))
KEYED_ROLES = frozenset(("formula_output", "lookup", "raw", "supplemental"))


def typed_keys(df: DataFrame, columns: list[str], fold_text: bool = False) -> list[Column]:
    """A typed key for each column; with fold_text, text is compared in its normal form."""
    kinds, keys = dict(df.dtypes), []
    for c in columns:
        held = F.col(f"`{c}`")
        typed = kinds[c].startswith("struct<kind:")  # a workbook's cell is a key already
        key = held if typed else cell_key(held, kinds[c])
        if fold_text and (typed or kinds[c] == "string"):
            folded = F.when(key["kind"] == "text", normalize_text(key["value"] if typed else held)).otherwise(key["value"])
            key = F.struct(key["kind"].alias("kind"), folded.alias("value"))
        keys.append(key)
    return keys


def populated(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Without rows that are blank in every column."""
    keys = typed_keys(df, columns or df.columns)
    return df.filter(reduce(or_, [k["kind"] != "blank" for k in keys]))


def duplicate_groups(df: DataFrame, columns: list[str], row: str, fold_text: bool = False, complete_only: bool = False) -> DataFrame:
    """Key (array of structs), first_row, n of each key that more rows than one have.

    The rows of a group are not gathered here, as a group may be most of the table: see duplicate_members.
    """
    keys = typed_keys(df, columns, fold_text)
    work = df.select(F.array(*keys).alias("key"), F.col(row).alias("_row"))
    if complete_only:
        work = work.filter(~F.exists("key", lambda k: k["kind"] == "blank"))
    return work.groupBy("key").agg(F.min("_row").alias("first_row"), F.count("*").alias("n")).filter("n > 1")


def duplicate_members(df: DataFrame, columns: list[str], row: str, fold_text: bool = False) -> DataFrame:
    """The rows of all duplicate groups, with the group's first row and size.

    The repeated keys are counted and joined back, so that a hot key is a part of many tasks and not one window's task.
    """
    work = df.withColumn("_key", F.array(*typed_keys(df, columns, fold_text)))
    repeated = work.groupBy("_key").agg(F.min(row).alias("first_row"), F.count("*").alias("n")).filter("n > 1")
    return work.join(repeated, "_key").drop("_key")


def incomplete_keys(df: DataFrame, columns: list[str], data: list[str] | None = None) -> DataFrame:
    """Rows with a blank in the key that are populated in the columns `data` (all of them by default)."""
    keys = typed_keys(df, columns)
    return populated(df, data).filter(reduce(or_, [k["kind"] == "blank" for k in keys]))


def header_collisions(labels: list[str]) -> dict[str, list[int]]:
    """Normal forms that several labels share, with their positions."""
    found: dict[str, list[int]] = {}
    for i, label in enumerate(labels):
        if str(label if label is not None else "").strip():
            found.setdefault(normalized_text(label), []).append(i)
    return {k: v for k, v in found.items() if len(v) > 1}


def resolve_columns(wanted: list[str], labels: list[str], what: str) -> tuple[list[str], list[str]]:
    """Actual labels of the wanted columns, and what could not be resolved."""
    places: dict[str, list[str]] = {}
    for label in labels:
        places.setdefault(normalized_text(label), []).append(label)
    found, errors = [], []
    for w in wanted:
        hits = places.get(normalized_text(w), [])
        if len(hits) == 1:
            found.append(hits[0])
        else:
            errors.append(f"{what} column {'is ambiguous' if hits else 'not found'}: {w}")
    return found, errors


def _reviewed(entry: dict, where: str) -> list[str]:
    """What a reviewed exception must say and does not."""
    lacks = [f"{where}.{f} is required" for f in ("reason", "owner", "evidence") if not isinstance(entry.get(f), str) or not entry[f].strip()]
    return lacks + ([] if timestamp_ok(entry.get("checked_at")) else [f"{where}.checked_at must be ISO-8601 with a time zone"])


def _key_literal(values: list) -> Column:
    def one(v: object) -> Column:
        if isinstance(v, bool):
            kind, value = "bool", str(v).lower()
        elif isinstance(v, (int, float)):
            kind, value = "number", None
            return F.struct(F.lit(kind).alias("kind"), F.lit(float(v)).cast("string").alias("value"))
        else:
            kind, value = ("blank", None) if v is None or not str(v).strip() else ("text", str(v))
        return F.struct(F.lit(kind).alias("kind"), F.lit(value).cast("string").alias("value"))

    return F.array(*[one(v) for v in values])


def audit_table(df: DataFrame, name: str, row: str, config: dict, headers: list[str] | None = None, sample_limit: int = 25) -> tuple[list[str], dict, dict[str, DataFrame]]:
    """Issues, facts and tables of one sheet or table; `row` numbers its rows and is not compared."""
    labels = headers if headers is not None else [c for c in df.columns if c != row]
    keys, ignored = config.get("key_columns", []), config.get("ignore_columns", [])
    for field, value in (("key_columns", keys), ("ignore_columns", ignored)):
        if not isinstance(value, list) or not all(isinstance(x, str) for x in value):
            raise ValueError(f"{name}: {field} must be a list of strings")
    allowed = config.get("allowed_duplicate_keys", [])
    if not isinstance(allowed, list):
        raise ValueError(f"{name}: allowed_duplicate_keys must be a list")
    for i, entry in enumerate(allowed):
        if not isinstance(entry, dict) or not isinstance(entry.get("values"), list) or len(entry["values"]) != len(keys):
            raise ValueError(f"{name}: allowed_duplicate_keys[{i}] needs {len(keys)} values")
        if lacks := _reviewed(entry, f"allowed_duplicate_keys[{i}]"):
            raise ValueError(f"{name}: {lacks[0]}")
    collisions = header_collisions(labels)
    key_cols, errors = resolve_columns(keys, labels, "key")
    skip, skip_errors = resolve_columns(ignored, labels, "ignored")
    errors += skip_errors
    data = [c for c in df.columns if c != row]
    rows = populated(df, data)
    fold, need_complete, limit = bool(config.get("normalize_key_text")), bool(config.get("require_complete_key", True)), int(config.get("sample_limit", sample_limit))
    issues, tables = list(errors), {}
    facts: dict = {"name": name, "headers": labels, "populated_data_rows": rows.count(), "duplicate_header_groups": collisions, "key_columns": keys, "allowed_duplicate_key_evidence": allowed}
    if config.get("check_duplicate_headers", True) and collisions:
        issues.append(f"{len(collisions)} duplicate header group(s)")
    compared = [c for c in data if c not in skip]
    if config.get("check_exact_rows", True) and compared:
        exact = tables["exact"] = duplicate_groups(rows, compared, row).persist()
        facts["exact_duplicate_group_count"] = exact.count()
        facts["exact_duplicate_groups_sample"] = [r.asDict() for r in exact.select("first_row", "n").orderBy("first_row").limit(limit).collect()]
        if facts["exact_duplicate_group_count"]:
            issues.append(f"{facts['exact_duplicate_group_count']} exact duplicate row group(s)")
    if key_cols and not errors:
        groups = duplicate_groups(rows, key_cols, row, fold, complete_only=True)
        if allowed:
            texts = [[normalized_text(v) if fold and isinstance(v, str) else v for v in e["values"]] for e in allowed]
            groups = groups.withColumn("allowed", reduce(or_, [F.col("key") == _key_literal(v) for v in texts]))
        else:
            groups = groups.withColumn("allowed", F.lit(False))
        groups = tables["keys"] = groups.persist()
        counts = {r["allowed"]: r["n"] for r in groups.groupBy("allowed").agg(F.count("*").alias("n")).collect()}
        facts |= {"duplicate_key_group_count": sum(counts.values()), "unexpected_duplicate_key_group_count": counts.get(False, 0)}
        for sort, flag in (("duplicate_key_groups_sample", "not allowed"), ("allowed_duplicate_key_groups_sample", "allowed")):
            facts[sort] = [{"key": dict(zip(keys, [k["value"] for k in r["key"]])), "first_row": r["first_row"], "n": r["n"]} for r in groups.filter(flag).orderBy("first_row").limit(limit).collect()]
        if counts.get(False):
            issues.append(f"{counts[False]} unexpected duplicate business-key group(s)")
        tables["incomplete"] = incomplete_keys(df, key_cols, data)
        facts["incomplete_key_row_count"] = tables["incomplete"].count()
        if need_complete and facts["incomplete_key_row_count"]:
            issues.append(f"{facts['incomplete_key_row_count']} populated row(s) have incomplete business keys")
    facts["issues"] = issues
    return issues, facts, tables


def sheet_contract(names: list[str], config: dict) -> list[str]:
    """Issues of a workbook's contract: every sheet is configured or excluded with evidence."""
    issues: list[str] = []
    sheets, excluded = config.get("sheets", []), config.get("excluded_sheets", [])
    if not isinstance(sheets, list) or not sheets:
        raise ValueError("config needs a non-empty sheets list")
    if not isinstance(excluded, list):
        raise ValueError("excluded_sheets must be a list")
    if config.get("check_normalized_sheet_names") is not True:
        issues.append("check_normalized_sheet_names must be true for a release audit")
    configured, left_out = [], []
    for sheet in sheets:
        if not isinstance(sheet, dict) or not isinstance(sheet.get("name"), str):
            raise ValueError("every sheets entry must be an object with a name")
        name, role = sheet["name"], sheet.get("role")
        configured.append(name)
        if role not in ROLES:
            issues.append(f"{name}: role must be one of {sorted(ROLES)}")
        issues += [f"{name}: {f} must be boolean" for f in ("check_duplicate_headers", "check_exact_rows") if sheet.get(f) not in (True, False)]
        if role in KEYED_ROLES and not sheet.get("key_columns"):
            issues.append(f"{name}: role {role} requires key_columns")
        if name not in names:
            issues.append(f"configured sheet not found: {name}")
    for i, entry in enumerate(excluded):
        if not isinstance(entry, dict) or not isinstance(entry.get("name"), str):
            issues.append(f"excluded_sheets[{i}] must be an object with a name")
            continue
        left_out.append(entry["name"])
        if entry.get("role") not in ("other", "pivot"):
            issues.append(f"excluded_sheets[{i}].role must be other or pivot")
        issues += _reviewed(entry, f"excluded_sheets[{i}]")
    for what, found in (
        ("sheet configured more than once", {n for n in configured if configured.count(n) > 1}), ("sheet excluded more than once", {n for n in left_out if left_out.count(n) > 1}),
        ("sheet both configured and excluded", set(configured) & set(left_out)), ("excluded sheet not found", set(left_out) - set(names)),
        ("workbook sheets missing from the audit contract", set(names) - set(configured) - set(left_out)),
    ):
        if found:
            issues.append(f"{what}: {', '.join(sorted(found))}")
    if clashes := header_collisions(names):
        issues.append(f"{len(clashes)} normalized sheet-name collision(s)")
    return issues


def audit_workbook_duplicates(names: list[str], config: dict, read_sheet) -> Report:
    """C05.  read_sheet(name, sheet config) gives a DataFrame of the sheet's rows, its row-number column, and its headers."""
    blockers, facts, tables = sheet_contract(names, config), [], {}
    for sheet in config["sheets"]:
        if sheet["name"] in names:
            df, row, headers = read_sheet(sheet["name"], sheet)
            issues, said, made = audit_table(df, sheet["name"], row, sheet, headers, int(config.get("sample_limit", 25)))
            blockers += [f"{sheet['name']}: {i}" for i in issues]
            facts.append(said)
            tables |= {f"{sheet['name']}/{k}": t for k, t in made.items()}
    return Report("workbook_duplicates", blockers, {"sheet_count": len(names), "configured_sheet_count": len(config["sheets"]), "excluded_sheets": config.get("excluded_sheets", []), "sheets": facts}, tables)
