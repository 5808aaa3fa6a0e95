"""Command line: python -m fiscora AUDIT ...  Writes a JSON report, prints one line, exits with 0 where the audit passed."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .operators import bootstrap, coverage, duplicates, flags, gates, lineage, overlap, reconcile, workbook
from .report import Report, encode, write_csv
from .sources import ooxml, tables


def session() -> SparkSession:
    return SparkSession.builder.appName("fiscora").getOrCreate()


def _object(path: str) -> dict:
    return lineage.read_object(Path(path))


def _finish(report: Report, path: str | None) -> int:
    if path:
        report.write(path)
    print(report.summary())
    return report.exit_code


def _finish_plain(result: dict, path: str | None = None) -> int:
    text = json.dumps(encode(result), indent=2, ensure_ascii=False)
    if path:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(text + "\n", encoding="utf-8")
    print(text)
    return 0 if result.get("passed", True) else 1


def run_reconcile(a: argparse.Namespace) -> int:
    spark = session()
    report = reconcile.reconcile(
        tables.read_table(spark, a.left, sheet=a.left_sheet), tables.read_table(spark, a.right, sheet=a.right_sheet), [k.strip() for k in a.keys.split(",") if k.strip()], a.left_value, a.right_value,
        a.absolute_tolerance, a.relative_tolerance, a.denominator, tuple(a.allow_status), a.duplicate_key_reason, a.null_value_reason,
    )
    if a.detail_csv:
        report.write_table("detail", a.detail_csv)
    return _finish(report, a.report)


def run_flags(a: argparse.Namespace) -> int:
    spark = session()
    report = flags.audit_flags(
        tables.read_table(spark, a.data, sheet=a.sheet, text_columns=tuple(a.text_column)), a.measure, a.id_column, _object(a.predicate_config) if a.predicate_config else None, a.flag_column, a.expected_flag_column, a.year_column,
        a.source_rule, a.allow_null_flag, a.allow_null_measures, a.require_both_values, a.absolute_tolerance, a.sample_limit,
    )
    if a.detail_csv and "detail" in report.tables:
        report.write_table("detail", a.detail_csv)
    return _finish(report, a.report)


def run_overlap(a: argparse.Namespace) -> int:
    spark, config = session(), _object(a.config)
    inputs = {r["name"]: tables.read_table(spark, r["input"], r.get("format"), r.get("sheet"), require_sheet=True, text_columns=tuple(r.get("text_columns", ()))) for r in config["ranges"]}
    report = overlap.audit_overlaps(config, tables.records(spark, a.tag_rules), tables.records(spark, a.code_dictionary), inputs)
    if a.detail_csv:
        for name, table in report.tables.items():
            if name.endswith("/pairs_by_year"):
                measures = [c.removesuffix("_overlap") for c in table.columns if c.endswith("_overlap")]
                write_csv(overlap.pair_detail(table, measures), f"{a.detail_csv}/{name.removesuffix('/pairs_by_year')}")
    return _finish(report, a.report)


def run_coverage(a: argparse.Namespace) -> int:
    spark, contract, base = session(), _object(a.contract), Path(a.contract).resolve().parent
    place = lambda p: str(p if Path(p).is_absolute() or "://" in p else base / p)
    target = contract.get("target") if isinstance(contract.get("target"), dict) else {}
    boundaries, has_geometry, error = None, False, None
    try:
        boundaries, has_geometry = tables.read_boundaries(spark, place(target["boundary_path"]), target["boundary_name_property"], target.get("boundary_format"), target.get("sheet"))
        boundaries.limit(1).collect()
    except Exception as e:  # whatever keeps the boundaries from being read is a finding of the audit
        boundaries, error = None, str(e).split("\n")[0]
    held: dict[str, DataFrame | Exception] = {}
    for d in contract.get("datasets") or []:
        if isinstance(d, dict) and d.get("name") and d.get("path"):
            try:
                held[d["name"]] = tables.read_table(spark, place(d["path"]), d.get("format"), d.get("sheet"))
            except Exception as e:  # as for boundaries
                held[d["name"]] = e
    return _finish(coverage.audit_coverage(contract, boundaries, held, has_geometry, error), a.report)


def run_duplicates(a: argparse.Namespace) -> int:
    if Path(a.workbook).suffix.lower() not in tables.AUDITED_WORKBOOKS:
        raise SystemExit("only OOXML workbooks can be checked for duplicates")
    spark = session()

    def read(name: str, config: dict) -> tuple[DataFrame, str, list[str]]:
        rows, labels = ooxml.read_sheet(spark, a.workbook, name, int(config.get("header_row", 1)), config.get("data_start_row"), config.get("max_data_row"), typed=True)
        return rows, "row_number", labels

    return _finish(duplicates.audit_workbook_duplicates(ooxml.sheet_names(a.workbook), _object(a.config), read), a.report)


def run_workbook(a: argparse.Namespace) -> int:
    report = workbook.audit_workbook(session(), a.workbook, a.limit)
    if a.sheet_csv:
        write_csv(workbook.sheet_table(report.tables), a.sheet_csv)
    return _finish(report, a.report)


def run_patch(a: argparse.Namespace) -> int:
    return _finish_plain(workbook.patch_workbook(a.base, json.loads(Path(a.patches).read_text(encoding="utf-8")), a.output, a.allow_old_mismatch))


def run_verify(a: argparse.Namespace) -> int:
    return _finish(workbook.verify_patch(session(), a.base, a.output, json.loads(Path(a.patches).read_text(encoding="utf-8"))), a.report)


def run_sources(a: argparse.Namespace) -> int:
    return _finish(lineage.audit_sources(Path(a.inventory)), a.report)


def run_manifest(a: argparse.Namespace) -> int:
    path, names = Path(a.manifest), tuple(a.repository) or None
    if a.action == "check":
        return _finish_plain(gates.check_record(path, a.ready, names))
    if a.action == "next":
        found = gates.next_step(gates.read_object(path), path.resolve().parent, names)
        return _finish_plain(found | {"passed": found["structurally_valid"]})
    if a.action == "upgrade":
        gates.write_record(gates.upgrade(gates.read_object(path), str(Path(a.output).resolve())), Path(a.output))
        return _finish_plain({"upgraded": a.output})
    record = gates.new_record(a.country, a.iso2, a.iso3, str(Path(a.workspace).resolve()), str(path.resolve()), tuple(a.repository))
    gates.write_record(record, path, a.force)
    return _finish_plain({"created": str(path), "country": record["country"]})


def run_start(a: argparse.Namespace) -> int:
    try:
        made = bootstrap.start(
            a.country, a.iso2, a.iso3, Path(a.workbook), a.source_owner, a.year, a.stage, a.currency, a.amount_unit, a.fiscal_year_convention, Path(a.repo_root), tuple(a.repository), Path(a.workspace),
            a.published_product, subnational_review=a.subnational_review, classification=a.data_classification,
        )
    except (OSError, ValueError) as e:
        return _finish_plain({"created": False, "error": str(e), "passed": False})
    return _finish_plain(made)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="fiscora", description=__doc__)
    sub = root.add_subparsers(dest="audit", required=True)

    def command(name: str, run, required: str = "", optional: str = "", lists: str = "", switches: str = "") -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        p.set_defaults(run=run)
        for words, more in ((required, {"required": True}), (optional, {}), (lists, {"action": "append", "default": []}), (switches, {"action": "store_true"})):
            for word in words.split():
                p.add_argument(f"--{word}", **more)
        return p

    p = command("reconcile", run_reconcile, "left right keys left-value right-value", "left-sheet right-sheet detail-csv report duplicate-key-reason null-value-reason", "allow-status")
    p.add_argument("--absolute-tolerance", type=float, default=0.5)
    p.add_argument("--relative-tolerance", type=float, default=0.05)
    p.add_argument("--denominator", choices=("left", "right", "max"), default="right")
    p = command("flags", run_flags, "data", "sheet expected-flag-column predicate-config source-rule detail-csv report", "measure id-column text-column", "allow-null-flag allow-null-measures require-both-values")
    p.add_argument("--flag-column", default="is_foreign")
    p.add_argument("--year-column", default="year")
    p.add_argument("--absolute-tolerance", type=float, default=0.01)
    p.add_argument("--sample-limit", type=int, default=25)
    command("overlap", run_overlap, "config tag-rules code-dictionary", "report detail-csv")
    command("coverage", run_coverage, "contract", "report")
    command("duplicates", run_duplicates, "workbook config", "report")
    command("workbook", run_workbook, "workbook", "report sheet-csv").add_argument("--limit", type=int, default=200)
    command("patch", run_patch, "base patches output", switches="allow-old-mismatch")
    command("verify", run_verify, "base patches output", "report")
    command("sources", run_sources, "inventory", "report")
    p = command("manifest", run_manifest, "manifest", "output country iso2 iso3 workspace", "repository", "ready force")
    p.add_argument("action", choices=("check", "next", "upgrade", "init"))
    p = command("start", run_start, "country iso2 iso3 workbook source-owner currency amount-unit fiscal-year-convention repo-root workspace", "", "stage repository published-product")
    p.add_argument("--year", type=int, action="append", required=True)
    p.add_argument("--subnational-review", choices=lineage.REVIEWS, default="pending")
    p.add_argument("--data-classification", choices=sorted(lineage.CLASSES), default="internal")
    return root


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
