"""Value normalisers (N01-N17) as Column expressions, with plain-Python twins for the driver's side.

All boolean results are null-free.  `strict` variants fold and normalise by full Unicode rules in an Arrow UDF; the
defaults stay in the JVM and differ only in characters such as the German sharp s.
"""

from __future__ import annotations

import datetime as dt
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Accepted spellings of flags, null markers of CSV readers, volatile spreadsheet functions.
TRUE_WORDS = ("1", "true")
FALSE_WORDS = ("0", "false")
CSV_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
VOLATILE = ("INDIRECT", "OFFSET", "NOW", "TODAY", "RAND", "RANDBETWEEN", "CELL", "INFO")

_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"
_YEAR = r"(?:19|20)\d{2}"


def text(c: Column) -> Column:
    """The value as text, null as empty."""
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Unicode white space off both ends (trim() knows only the space)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    """Null, or nothing but white space."""
    return c.isNull() | ~text(c).rlike(r"(?U)\S")


def is_empty(c: Column) -> Column:
    """Null or the empty string; white space is a value."""
    return c.isNull() | (text(c) == "")


def normalize_name(c: Column) -> Column:
    """Stripped, null as empty, case kept."""
    return strip(text(c))


def to_number(c: Column, dtype: str = "string") -> Column:
    """A double, or null where the text is no number; NaN is null, and so is an overflow."""
    if dtype == "string":
        value = F.when(c.rlike(_NUMBER), c.try_cast("double"))
        return F.when(F.isnan(value) | ((F.abs(value) == float("inf")) & ~F.lower(c).contains("inf")), None).otherwise(value)
    value = c.cast("double")
    return F.when(~F.isnan(value), value)


def fold(c: Column, strict: bool = False) -> Column:
    """Text for comparison without case."""
    return _casefold(text(c)) if strict else F.lower(text(c))


@F.pandas_udf(StringType())
def _casefold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else x.casefold())


@F.pandas_udf(StringType())
def _normalized(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else normalized_text(x))


def normalize_text(c: Column, strict: bool = True) -> Column:
    """Compatibility form, single spaces, no case.  Not strict: without the compatibility form."""
    if strict:
        return _normalized(text(c))
    return F.lower(F.regexp_replace(strip(text(c)), r"(?U)\s+", " "))


def normalized_text(value: object) -> str:
    return " ".join(unicodedata.normalize("NFKC", str(value)).split()).casefold()


def flag(c: Column) -> Column:
    """struct(status, value); status is valid, null or invalid.

    Integral 0 and 1 of any numeric type are valid, also in a column with nulls.
    """
    word = F.lower(strip(text(c)))
    word = F.regexp_replace(word, r"^([01])\.0$", "$1")
    status = F.when(is_blank(c), "null").when(word.isin(*TRUE_WORDS, *FALSE_WORDS), "valid").otherwise("invalid")
    return F.struct(status.alias("status"), F.when(status == "valid", word.isin(*TRUE_WORDS)).alias("value"))


def cell_key(c: Column, dtype: str = "string") -> Column:
    """struct(kind, value) of a typed value: numbers of equal value are equal, a boolean is no number."""
    kinds = {"boolean": "bool", "date": "date", "timestamp": "date", "timestamp_ntz": "date", "string": "text"}
    kind = kinds.get(dtype, "number")
    if kind == "number":
        number = to_number(c, dtype)
        return F.struct(F.when(number.isNull(), "blank").otherwise("number").alias("kind"), (number + F.lit(0.0)).cast("string").alias("value"))
    value = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") if kind == "date" else c.cast("string")
    blank = is_blank(c) if kind == "text" else c.isNull()
    return F.struct(F.when(blank, "blank").otherwise(kind).alias("kind"), F.when(~blank, value).alias("value"))


def years(value: str | None) -> set[str]:
    """Every year named, and all years of every range."""
    said = str(value or "")
    found = set(re.findall(rf"\b{_YEAR}\b", said))
    for a, b in re.findall(rf"({_YEAR})\s*[-–—]\s*({_YEAR})", said):
        found |= {str(y) for y in range(int(a), int(b) + 1)}
    return found


def year_array(c: Column) -> Column:
    """N10 as a Column: sorted array of years."""
    single = F.regexp_extract_all(text(c), F.lit(rf"\b({_YEAR})\b"), 1)
    spans = F.regexp_extract_all(text(c), F.lit(rf"({_YEAR}\s*[-–—]\s*{_YEAR})"), 1)

    def ends(x: Column) -> Column:
        return F.regexp_extract_all(x, F.lit(rf"({_YEAR})"), 1)

    def spread(x: Column) -> Column:
        a, b = F.element_at(ends(x), 1).cast("int"), F.element_at(ends(x), -1).cast("int")
        return F.when(b >= a, F.transform(F.sequence(a, F.greatest(a, b)), lambda y: y.cast("string"))).otherwise(F.array().cast("array<string>"))

    return F.array_sort(F.array_distinct(F.concat(single, F.flatten(F.transform(spans, spread)))))


def timestamp_ok(value: object) -> bool:
    """ISO-8601 with a time zone; Z is one."""
    if not isinstance(value, str) or not value.strip():
        return False
    try:
        return dt.datetime.fromisoformat(value.replace("Z", "+00:00")).tzinfo is not None
    except ValueError:
        return False


def column_number(letters: Column) -> Column:
    """A is 1, Z is 26, AA is 27."""
    return F.aggregate(F.split(letters, ""), F.lit(0), lambda acc, ch: F.when(ch == "", acc).otherwise(acc * 26 + F.ascii(ch) - 64))


def cell_position(ref: Column) -> tuple[Column, Column]:
    """Column number and row of a reference such as AB12; null where it is none."""
    ok = ref.rlike(r"^[A-Z]+[0-9]+$")
    return F.when(ok, column_number(F.regexp_extract(ref, r"^([A-Z]+)", 1))), F.when(ok, F.regexp_extract(ref, r"([0-9]+)$", 1).cast("int"))


def function_tokens(formula: Column) -> Column:
    """Function names of a formula, upper case, of dotted names the last part."""
    names = F.regexp_extract_all(text(formula), F.lit(r"(?i)\b([A-Z][A-Z0-9_.]*)\s*\("), 1)
    return F.transform(names, lambda x: F.element_at(F.split(F.upper(x), r"\."), -1))


def normalize_formula(c: Column) -> Column:
    """Exactly one leading equals sign."""
    return F.concat(F.lit("="), F.regexp_replace(text(c), r"^=+", ""))


def normalized_formula(value: str) -> str:
    return "=" + value.lstrip("=")


def number_text(value: object) -> str:
    """Booleans as 1 and 0, numbers in up to 15 significant digits."""
    return str(int(value)) if isinstance(value, bool) else f"{float(value):.15g}"


def trim_trailing_blanks(values: Column) -> Column:
    """An array of strings without its blank tail."""
    last = F.aggregate(
        F.transform(values, lambda x, i: F.when(~is_blank(x), i + 1).otherwise(0)), F.lit(0), lambda a, b: F.greatest(a, b.cast("int"))
    )
    return F.when(last > 0, F.slice(values, 1, F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<string>"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is zero or null."""
    return F.try_divide(numerator, F.nullif(denominator, F.lit(0.0)))


def exact_sum(c: Column, scale: int | None = None) -> Column:
    """Sum as double; with a scale, over decimals, so that no order of additions shows."""
    return F.sum(c) if scale is None else F.sum(c.cast(f"decimal(28,{scale})")).cast("double")
