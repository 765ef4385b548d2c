"""Ping cleaning, filtering and time bucketing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RAW_TIMESTAMP_FORMAT, SHIP_TYPES
from ..functions import col_of


def keep_ship_types(df: DataFrame, types=SHIP_TYPES, col: str = "ship_type") -> DataFrame:
    """B1: keep the listed vessel classes (pushed to the scan as an IN filter)."""
    return df.where(F.col(col).isin(list(types)))


def parse_timestamp(c, fmt: str = RAW_TIMESTAMP_FORMAT, strict: bool = False) -> Column:
    """Day-first timestamp.  Lenient (NULL on bad text) unless strict."""
    c = col_of(c)
    return F.to_timestamp(c, fmt) if strict else F.try_to_timestamp(c, F.lit(fmt))


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def between_dates(df: DataFrame, start=None, end=None, ts: str = "ts") -> DataFrame:
    """Calendar date of ts in [start, end], written as a half-open
    timestamp range so the predicate still pushes down to the scan."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(_as_date(start)).cast("timestamp_ntz"))
    if end is not None:
        nxt = _as_date(end) + dt.timedelta(days=1)
        df = df.where(F.col(ts) < F.lit(nxt).cast("timestamp_ntz"))
    return df


def check_range(start, end) -> None:
    """Argument check of a date range."""
    if start is not None and end is not None and _as_date(start) > _as_date(end):
        raise ValueError(f"start date {start} is after end date {end}")


def in_box(lat, lon, box) -> Column:
    """Inclusive bounding box (lat_min, lat_max, lon_min, lon_max)."""
    lat_min, lat_max, lon_min, lon_max = box
    return col_of(lat).between(lat_min, lat_max) & col_of(lon).between(lon_min, lon_max)


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with a null in any (or the listed) column."""
    return df.na.drop(subset=subset)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns by type, in schema order."""
    from pyspark.sql.types import NumericType
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]
