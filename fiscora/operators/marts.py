"""Bronze to gold: cascades, comparisons, conservation, crosswalks and release checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import exact_sum, safe_ratio


def owner_cascade(rules: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The first rule that holds owns the row; no shuffle."""
    return F.coalesce(*[F.when(mask, F.lit(code)) for mask, code in rules], F.lit(otherwise))


def label_codes(df: DataFrame, column: str, dictionary: DataFrame, code: str, labels: list[str]) -> DataFrame:
    """Canonical labels of codes; unknown codes stay, with null labels.

    A code that the dictionary repeats gives a row each; repeated_keys(dictionary, [code]) finds them, as it does for the
    sources of J08's mapping and the keys of J10's population.
    """
    side = dictionary.select(F.col(code).alias("_code"), *labels)
    return df.join(side, df[column] == F.col("_code"), "left").drop("_code")


def region_contract(df: DataFrame, column: str, mapping: DataFrame, boundaries: DataFrame, boundary_name: str) -> DataFrame:
    """Adds region and on_map; every row stays, also those of no boundary."""
    labels = mapping.select(F.col("source").alias("_source"), F.col("target").alias("_target"))
    named = df.join(labels, df[column] == F.col("_source"), "left").withColumn("region", F.coalesce("_target", column)).drop("_source", "_target")
    units = boundaries.select(F.col(boundary_name).alias("_unit")).distinct()
    return named.join(units, F.col("region") == F.col("_unit"), "left").withColumn("on_map", F.col("_unit").isNotNull()).drop("_unit")


def crosswalk_sums(df: DataFrame, unit: str, crosswalk: DataFrame, keys: list[str], measures: list[str], scale: int | None = None) -> DataFrame:
    """Sums of finer units over the target each maps to (crosswalk: source, target)."""
    joined = df.join(crosswalk.select(F.col("source").alias("_source"), F.col("target").alias("target")), df[unit] == F.col("_source"))
    return joined.groupBy("target", *keys).agg(F.count("*").alias("rows"), *[exact_sum(F.col(m), scale).alias(m) for m in measures])


def crosswalk_problems(df: DataFrame, unit: str, crosswalk: DataFrame) -> DataFrame:
    """(source, problem): sources that map to several targets, and units that the crosswalk lacks."""
    several = crosswalk.groupBy("source").agg(F.count_distinct("target").alias("n")).filter("n > 1").select("source", F.lit("several targets").alias("problem"))
    lacks = df.select(F.col(unit).alias("source")).distinct().join(crosswalk.select("source"), "source", "left_anti").select("source", F.lit("no target").alias("problem"))
    return several.unionByName(lacks)


def per_unit(df: DataFrame, population: DataFrame, keys: list[str], measure: str, people: str) -> DataFrame:
    """Measure by head; rows without population stay, with a null."""
    side = population.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(people).alias("population"))
    joined = df.join(side, [df[k].eqNullSafe(F.col(f"_{k}")) for k in keys], "left").drop(*[f"_{k}" for k in keys])
    return joined.withColumn("per_unit", safe_ratio(F.col(measure), F.col("population").cast("double")))


def comparison_matrix(df: DataFrame, sets: list[list[str]], measures: list[str], scale: int | None = None) -> DataFrame:
    """Totals of several groupings in one pass; `grouping` tells which columns a row sums over (bit by column)."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().cast("long").alias("grouping"), F.count("*").alias("rows"), *[exact_sum(F.col(m), scale).alias(m) for m in measures]
    )


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, and nulls of each column, in one row."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def totals(df: DataFrame, keys: list[str], measures: list[str], scale: int | None = None) -> DataFrame:
    """Rows and sums by keys."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), *[exact_sum(F.col(m), scale).alias(m) for m in measures])


def layer_conservation(layers: list[tuple[str, DataFrame]], measure: str, scale: int | None = None) -> DataFrame:
    """(position, layer, rows, amount) of every layer; first_loss finds where something went."""
    parts = [df.agg(F.count("*").alias("rows"), exact_sum(F.col(measure), scale).alias("amount")).select(F.lit(i).alias("position"), F.lit(name).alias("layer"), "rows", "amount") for i, (name, df) in enumerate(layers)]
    return reduce(DataFrame.unionByName, parts)


def first_loss(layers: DataFrame, tolerance: float = 0.01) -> str | None:
    """The first layer whose rows or amount differ from the one before; the table has one row a layer."""
    rows = layers.orderBy("position").collect()
    for a, b in zip(rows, rows[1:]):
        if a["rows"] != b["rows"] or abs((a["amount"] or 0.0) - (b["amount"] or 0.0)) > tolerance:
            return b["layer"]
    return None


def union_countries(tables: dict[str, DataFrame], country: str = "country_name") -> DataFrame:
    """All countries by column name; columns that a country lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(country, F.lit(name)) for name, df in sorted(tables.items())])


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that should be unique and are not."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def population_problems(df: DataFrame, region: str, year: str, people: str, years: list[int], units: int, published: dict[int, float] | None = None, tolerance: float = 0.5) -> list[str]:
    """What a population table breaks; one pass over the table and one over its years."""
    issues = []
    if n := repeated_keys(df, [region, year]).count():
        issues.append(f"{n} repeated region-years")
    seen = df.agg(F.count_if(F.col(people).isNull()).alias("null"), F.count_if(F.col(people) <= 0).alias("low")).first()
    issues += [f"{seen[k]} rows of {what} population" for k, what in (("null", "null"), ("low", "no positive")) if seen[k]]
    held = {r["y"]: r for r in df.groupBy(F.col(year).alias("y")).agg(F.count_distinct(region).alias("units"), F.sum(people).alias("total")).collect()}
    for y in years:
        if y not in held:
            issues.append(f"year {y} is missing")
            continue
        if held[y]["units"] != units:
            issues.append(f"year {y} has {held[y]['units']} units, not {units}")
        if published and y in published and abs(float(held[y]["total"] or 0) - published[y]) > tolerance:
            issues.append(f"year {y} does not add up to its published total")
    return issues


def dashboard_differences(shown: DataFrame, truth: DataFrame, keys: list[str], measure: str, tolerance: float = 0.5) -> DataFrame:
    """C14: keys whose shown value differs from the aggregate, or that only one side has."""
    from .reconcile import compare

    return compare(shown, truth, keys, measure, measure, tolerance, 0.0).filter("status <> 'MATCH'")


def map_ranges(values: DataFrame, name: str, measure: str, boundaries: DataFrame, boundary_name: str) -> DataFrame:
    """C15 in one row: names without a boundary, boundaries without data, and the legend's range over data alone."""
    units = boundaries.select(F.col(boundary_name).alias("_unit")).distinct()
    joined = values.join(units, F.col(name) == F.col("_unit"), "full_outer")
    return joined.agg(
        F.count_if(F.col("_unit").isNull()).alias("unmatched"), F.count_if(F.col(measure).isNull() & F.col("_unit").isNotNull()).alias("no_data"),
        F.min(measure).alias("legend_min"), F.max(measure).alias("legend_max"),
    )


def lost_years(gold: dict[str, DataFrame], aggregate: DataFrame, country: str = "country_name", year: str = "year") -> DataFrame:
    """(country, year) of every country-year that the aggregate lacks."""
    held = aggregate.select(F.col(country).alias("country"), F.col(year).cast("long").alias("year")).distinct()
    every = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("country"), F.col(year).cast("long").alias("year")).distinct() for name, df in sorted(gold.items())])
    return every.join(held, ["country", "year"], "left_anti")


def registry_problems(gold: dict[str, DataFrame], aggregate: DataFrame, registered: list[str], country: str = "country_name", year: str = "year", most: int = 100) -> list[str]:
    """Each country registered once, its columns in the aggregate, and no country-year lost (all: lost_years)."""
    issues = [f"country registered {registered.count(c)} times: {c}" for c in sorted(gold) if registered.count(c) != 1]
    issues += [f"aggregate lacks columns of {name}: {lacks}" for name, df in sorted(gold.items()) if (lacks := sorted(set(df.columns) - set(aggregate.columns)))]
    lost = lost_years(gold, aggregate, country, year)
    counts = {r["country"]: r["n"] for r in lost.groupBy("country").agg(F.count("*").alias("n")).collect()}
    order = Window.partitionBy("country").orderBy("year")
    first: dict[str, list[int]] = {}
    for r in lost.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= most).orderBy("country", "year").collect():
        first.setdefault(r["country"], []).append(r["year"])
    return issues + [f"aggregate lost years of {name}: {first[name]}" + (f" and {n - most} more" if n > most else "") for name, n in sorted(counts.items())]
