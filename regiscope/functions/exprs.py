"""Scalar column expressions, which keep NULL as the missing value, and dates read in orders learned from their column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The UK postcode pattern.
POSTCODE = r"(GIR 0AA)|([A-Z]{1,2}[0-9][0-9A-Z]? ?[0-9][A-Z]{2})"
#: Date orders tried in turn, after separators have become "-".
DATE_FORMATS = ("d-MMMM-yyyy", "d-MMM-yyyy", "d-M-yyyy", "d-M-yy", "ddMMyyyy", "yyyy-M-d", "yyyyMMdd", "MMMM-d-yyyy", "MMM-d-yyyy", "M-d-yyyy")


def percent_change(old: Column, new: Column) -> Column:
    """Change from old to new in per cent; NULL where old is 0."""
    return F.try_divide(new - old, old) * 100


def normalise_postcode(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), " ", "")


def postcode_in(address: Column) -> Column:
    """The first postcode in free text, NULL if there is none."""
    return F.nullif(F.regexp_extract(F.upper(address), POSTCODE, 0), F.lit(""))


def token(c: Column, k: int, separator: str = "_") -> Column:
    """The k-th part (from 1), "" if there are fewer, NULL for NULL."""
    return F.when(c.isNotNull(), F.coalesce(F.try_element_at(F.split(c, separator), F.lit(k)), F.lit("")))


def strip_suffix(c: Column, suffix: str) -> Column:
    return F.regexp_replace(c, suffix.replace(".", r"\.") + "$", "")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def to_number(c: Column) -> Column:
    """Plain decimal numbers only; anything else (thousands separators, type suffixes) is NULL."""
    return F.when(F.trim(c).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), F.trim(c).try_cast("double"))


def _plain_date(c: Column) -> Column:
    """A date's text with "-" for all separators and without the ends of ordinals."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"(?i)(?<=[0-9])(st|nd|rd|th)\b", ""), r"[\s,./-]+", "-")


def parse_date(c: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Dates in mixed orders, day first before year first before month first."""
    return F.coalesce(*(F.try_to_date(_plain_date(c), f) for f in formats))


def date_orders(df: DataFrame, column: str, formats: tuple[str, ...] = DATE_FORMATS) -> tuple[str, ...]:
    """The formats by how many distinct texts of the column each can read, the most first; of equal ones in the given order. One pass, one row."""
    texts = df.select(_plain_date(F.col(column)).alias("t")).where("t IS NOT NULL").distinct()
    counts = texts.agg(*(F.count(F.try_to_date("t", f)).alias(f"f{k}") for k, f in enumerate(formats))).first()
    return tuple(f for _, f in sorted(((-counts[k], k), f) for k, f in enumerate(formats)))


def with_trained_dates(df: DataFrame, column: str, formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """The column's texts as dates, in the orders that read most of its distinct texts: month first where the column is so. Two passes."""
    return df.withColumn(column, parse_date(F.col(column), date_orders(df, column, formats)))


def age_in_years(date: Column, as_of: Column) -> Column:
    return F.datediff(as_of, date) / 365.0


def matches(c: Column, pattern: str, ignore_case: bool = True) -> Column:
    """Regex test that is false, never NULL, for NULL."""
    return F.coalesce(c.rlike(("(?i)" if ignore_case else "") + pattern), F.lit(False))


def round_half_even(c: Column, places: int = 0) -> Column:
    return F.bround(c, places)


def label_number(c: Column, places: int = 1) -> Column:
    """A rounded number as text, whole ones without a decimal point."""
    return F.regexp_replace(round_half_even(c, places).cast("string"), r"\.0$", "")


def filled(*columns: str) -> Column:
    """How many of the columns hold a value."""
    return sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))


def log10(c: Column) -> Column:
    """NULL for what is not positive."""
    return F.when(c > 0, F.log10(c))
