"""The result of an audit: a verdict, its blockers, small facts, and lazy tables."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame


def encode(value: object) -> object:
    """What JSON cannot hold becomes text; NaN becomes null."""
    if isinstance(value, float) and value != value:
        return None
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, dict):
        return {str(k): encode(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [encode(v) for v in value]
    if isinstance(value, (set, frozenset)):
        return sorted(encode(v) for v in value)
    return value


def write_csv(df: DataFrame, path: str) -> None:
    """A table as CSV with a header; white space around values stays (the writer would cut it)."""
    df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


@dataclass
class Report:
    """`facts` are small and collected; `tables` are DataFrames that nobody has computed yet."""

    check: str
    blockers: list[str] = field(default_factory=list)
    facts: dict = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    extra_failure: bool = False

    @property
    def passed(self) -> bool:
        return not self.blockers and not self.extra_failure

    @property
    def exit_code(self) -> int:
        return 0 if self.passed else 1

    def as_dict(self) -> dict:
        return {"check": self.check, "passed": self.passed, **encode(self.facts), "blockers": list(self.blockers)}

    def summary(self) -> str:
        return json.dumps({"check": self.check, "passed": self.passed, "blockers": len(self.blockers)}, ensure_ascii=False)

    def write(self, path: str | Path) -> Path:
        """Two spaces of indent, text as it is, a newline at the end."""
        path = Path(path)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(self.as_dict(), indent=2, ensure_ascii=False) + "\n", encoding="utf-8")
        return path

    def write_table(self, name: str, path: str) -> None:
        """A detail table as CSV with a header, written by the executors."""
        write_csv(self.tables[name], path)


def sample(df: DataFrame, order: list[str], limit: int) -> list[dict]:
    """The first rows in a stated order, for a report."""
    return [encode(r.asDict(recursive=True)) for r in df.orderBy(*order).limit(limit).collect()]
