"""Normalisation steps applied before the combine and before storing usage.

P7  drop rows whose date text cannot be parsed
P9  zero-fill numeric columns
P10 text columns that are wholly NULL -> '' (partly NULL text is left alone)
P11 dates/timestamps -> ``yyyy-MM-dd`` text, missing -> ''
P12 NaN / +-Inf -> NULL on every floating column
P13 trailing N-day window ending at the latest date
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, FloatType, NumericType, StringType,
                               TimestampNTZType, TimestampType)

from popcorr.functions import kpi


def drop_bad_dates(df: DataFrame, text_col: str, fmt: str = "yyyy-MM-dd",
                   out: str = "date") -> DataFrame:
    """Parse ``text_col`` with ``fmt``; rows that do not parse are dropped."""
    return (df.withColumn(out, kpi.parse_date(text_col, fmt))
              .where(F.col(out).isNotNull()))


def zero_fill(df: DataFrame) -> DataFrame:
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.fillna(0, subset=num) if num else df


def fill_all_null_text(df: DataFrame) -> DataFrame:
    """Text columns with no non-NULL value become ''.

    One aggregate pass counts non-NULL values per text column (a one-row
    result); only the all-NULL columns are filled.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not text:
        return df
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in text]).first().asDict()
    empty = [c for c in text if counts[c] == 0]
    return df.fillna("", subset=empty) if empty else df


def dates_as_text(df: DataFrame) -> DataFrame:
    """Date and timestamp columns -> ``yyyy-MM-dd`` text; missing -> ''."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)):
            cols.append(F.coalesce(F.date_format(F.col(f.name), "yyyy-MM-dd"), F.lit("")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def clean_all_numeric(df: DataFrame) -> DataFrame:
    """NaN/Inf -> NULL on every double/float column."""
    return df.select(*[
        kpi.clean_numeric(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def latest_date(df: DataFrame, date_col: str = "date") -> _dt.date | None:
    """The maximum date (a one-row aggregate)."""
    return df.agg(F.max(date_col).alias("m")).first()["m"]


def earliest_date(df: DataFrame, date_col: str = "date") -> _dt.date | None:
    return df.agg(F.min(date_col).alias("m")).first()["m"]


def trailing_window(df: DataFrame, days: int = 30, date_col: str = "date") -> DataFrame:
    """Rows with ``date >= max(date) - (days - 1)``.

    The maximum is a one-row aggregate turned into a literal, so the filter
    is a plain predicate Catalyst can push into the scan.
    """
    m = latest_date(df, date_col)
    if m is None:
        return df.limit(0)
    return df.where(F.col(date_col) >= F.lit(m - _dt.timedelta(days=days - 1)))


def history_window(df: DataFrame, run_date: str, days: int = 365,
                   date_col: str = "date") -> DataFrame:
    """Rows with ``run_date - days <= date < run_date`` (end exclusive)."""
    end = _dt.datetime.strptime(run_date, "%Y%m%d").date()
    start = end - _dt.timedelta(days=days)
    return df.where((F.col(date_col) >= F.lit(start)) & (F.col(date_col) < F.lit(end)))
