"""Column builders for cleaning, casting and null handling."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Texts that stand for "no value" in raw extracts.
PLACEHOLDERS = ("null", "n/a", "none", "missing", "unknown", "")

# Fixed value: numeric code for "no value" in raw extracts.
NUMERIC_SENTINELS = (-999,)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_id(c: Column | str) -> Column:
    """Identifier as trimmed text."""
    return F.trim(col(c).cast("string"))


def lower_text(c: Column | str) -> Column:
    return F.lower(F.trim(col(c)))


def upper_text(c: Column | str) -> Column:
    return F.upper(F.trim(col(c)))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def placeholder_to_null(c: Column | str, placeholders: Sequence[str] = PLACEHOLDERS) -> Column:
    """NULL when the trimmed, lower-cased text is any of the placeholders."""
    c = col(c)
    return F.when(~F.lower(F.trim(c)).isin([p.lower() for p in placeholders]), c)


def clamp_null(
    c: Column | str,
    lo: float | None = None,
    hi: float | None = None,
    sentinels: Iterable[float] = (),
    lo_open: bool = False,
) -> Column:
    """NULL outside ``[lo, hi]`` (``(lo, hi]`` with ``lo_open``) or on a sentinel; the row stays."""
    c = col(c)
    keep = F.lit(True)
    if lo is not None:
        keep = keep & ((c > lo) if lo_open else (c >= lo))
    if hi is not None:
        keep = keep & (c <= hi)
    sentinels = list(sentinels)
    if sentinels:
        keep = keep & ~c.isin(sentinels)
    return F.when(keep, c)


def to_bool(c: Column | str) -> Column:
    text = lower_text(c)
    return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))


def safe_cast(c: Column | str, type_name: str) -> Column:
    """NULL instead of an error on text that does not parse."""
    return col(c).try_cast(type_name)


def parse_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    if fmt is None:
        return F.try_to_timestamp(col(c))
    return F.try_to_timestamp(col(c), F.lit(fmt))


def zip_text(c: Column | str, width: int = 5) -> Column:
    """Zip prefix as text with its leading zeros."""
    return F.lpad(col(c).cast("string"), width, "0")


def strip_all_text(df: DataFrame) -> DataFrame:
    """Trim every string column the schema lists."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: F.trim(F.col(n)) for n in names}) if names else df


def not_deleted(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    """Rows whose soft-delete flag is not true; an absent flag keeps the row."""
    return df.filter(~F.coalesce(F.col(flag), F.lit(False)))


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose key columns are present (text keys also non-empty)."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, T.StringType):
            df = df.filter(F.trim(F.col(name)) != "")
    return df


def round_half_up(c: Column, digits: int) -> Column:
    """Round the decimal reading of a double, so 0.125 becomes 0.13 on every platform."""
    return F.round(c.cast("decimal(38,10)"), digits).cast("double")


def total(c: Column | str) -> Column:
    """SUM as a double; exact while the input column is a decimal."""
    return F.sum(col(c)).cast("double")


def mean(c: Column | str) -> Column:
    """AVG from an exact SUM, free of the summing order; NULL for no values."""
    return F.try_divide(total(c), F.count(col(c)))


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double, NULL for a zero or absent denominator."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def bool_mean(flag: Column | str) -> Column:
    """Share of true among the non-null flags."""
    return F.avg(col(flag).cast("int"))


def count_true(flag: Column | str) -> Column:
    return F.count_if(F.coalesce(col(flag), F.lit(False)))
