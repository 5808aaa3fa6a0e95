"""Table scans by suffix."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import CSV_NULLS, normalize_name

WORKBOOKS = (".xlsx", ".xlsm")
AUDITED_WORKBOOKS = (".xlsx", ".xlsm", ".xltx", ".xltm")


def kind_of(path: str, kind: str | None = None) -> str:
    found = (kind or PurePosixPath(path.rstrip("/")).suffix.lstrip(".")).lower()
    if found not in ("csv", "parquet", "json", "geojson", "xlsx", "xlsm"):
        raise ValueError(f"unsupported table format: {path}")
    return found


def read_table(spark: SparkSession, path: str, kind: str | None = None, sheet: str | None = None, require_sheet: bool = False, text_columns: tuple[str, ...] = ()) -> DataFrame:
    """S01-S04.  CSV types are inferred, but `text_columns` stay text, so that codes keep their zeros.

    Null markers of a CSV (N07) become nulls in text columns as well.
    """
    kind = kind_of(path, kind)
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind in ("json", "geojson"):
        return spark.read.option("multiLine", True).json(path)
    if kind == "csv":
        df = spark.read.option("header", True).option("inferSchema", True).option("escape", '"').option("multiLine", True).csv(path)
        if text_columns:
            raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(", ".join(f"`{c}` {'string' if c in text_columns else t}" for c, t in df.dtypes)).csv(path)
            df = raw
        return df.select([F.when(~F.col(c).isin(*CSV_NULLS), F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])
    if require_sheet and not sheet:
        raise ValueError(f"a workbook needs a sheet: {path}")
    from .ooxml import read_sheet

    return read_sheet(spark, path, sheet)[0]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, no inference; a byte-order mark is not part of the first name."""
    df = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", True).csv(path)
    clean = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return clean.na.fill("")


def records(spark: SparkSession, path: str, most: int = 1_000_000) -> list[dict]:
    """S05 on the driver: rules and dictionaries, which are small; a larger file is refused."""
    rows = read_records(spark, path).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{path} has more than {most} records; use read_records")
    return [r.asDict() for r in rows]


def read_boundaries(spark: SparkSession, path: str, name: str, kind: str | None = None, sheet: str | None = None) -> tuple[DataFrame, bool]:
    """(name, geometry) and whether there is geometry to check; a missing property is an empty name."""
    kind = kind_of(path, kind)
    if kind in ("json", "geojson"):
        schema = "features array<struct<properties: map<string, string>, geometry: string>>"
        features = spark.read.option("multiLine", True).schema(schema).json(path).select(F.explode_outer("features").alias("f")).filter("f is not null")
        return features.select(normalize_name(F.col("f.properties")[name]).alias("name"), F.col("f.geometry").alias("geometry")), True
    df = read_table(spark, path, kind, sheet)
    if name not in df.columns:
        raise ValueError(f"boundary name column {name!r} is not in {path}")
    return df.select(normalize_name(F.col(name)).alias("name"), F.lit(None).cast("string").alias("geometry")), False
