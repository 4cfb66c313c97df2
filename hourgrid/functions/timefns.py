"""Hour arithmetic, time zones, calendar features, key strings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.dimensions import CROP_BURNING_MONTHS, FESTIVAL_WEIGHTS, RUSH_HOURS

LOCAL_ZONE = "Asia/Kolkata"
DEFAULT_OFFSET = "+05:30"


def floor_hour(ts: Column) -> Column:
    """Hour a timestamp falls into, as a zone-less UTC timestamp."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def floor_day(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def hour_number(ts: Column) -> Column:
    """Whole hours since the epoch; the ordering column of all series windows."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / 3600)


def hour_start(number: Column) -> Column:
    """Inverse of :func:`hour_number`."""
    return F.timestamp_seconds(number * 3600).cast("timestamp_ntz")


def rush_hour(ts: Column) -> Column:
    hour = F.hour(ts)
    (a, b), (c, d) = RUSH_HOURS
    return hour.between(a, b) | hour.between(c, d)


def with_calendar(df: DataFrame, ts: str = "ds") -> DataFrame:
    """hour, dayofweek (0 = Monday), month, is_weekend, is_rush_hour."""
    t = F.col(ts)
    return df.withColumns({
        "hour": F.hour(t),
        "dayofweek": F.weekday(t),
        "month": F.month(t),
        "is_weekend": (F.weekday(t) >= 5).cast("int"),
        "is_rush_hour": rush_hour(t).cast("int"),
    })


def with_cyclic(df: DataFrame) -> DataFrame:
    """sin/cos encodings of hour, dayofweek and month."""
    periods = {"hour": ("hour", 24), "dow": ("dayofweek", 7), "month": ("month", 12)}
    columns = {}
    for short, (source, period) in periods.items():
        angle = F.col(source) * (2 * math.pi) / period
        columns[f"{short}_sin"] = F.sin(angle)
        columns[f"{short}_cos"] = F.cos(angle)
    return df.withColumns(columns)


def with_season_effects(df: DataFrame, ts: str = "ds") -> DataFrame:
    """Month-driven crop-burning flag and festival weight; replaces source columns."""
    month = F.month(F.col(ts))
    festival = F.lit(0.0)
    for m, weight in FESTIVAL_WEIGHTS.items():
        festival = F.when(month == m, weight).otherwise(festival)
    return df.withColumns({
        "crop_burning": month.isin(CROP_BURNING_MONTHS).cast("double"),
        "festival_period": festival,
    })


def utc_wall(instant: Column) -> Column:
    """An instant as a zone-less UTC time, whatever the session's zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def local_to_utc(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts.cast("timestamp_ntz"))


def utc_to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def local_iso(ts: Column) -> Column:
    """Local time with its offset, e.g. ``2024-01-01T05:30:00+05:30``."""
    return F.concat(F.date_format(utc_to_local(ts), "yyyy-MM-dd'T'HH:mm:ss"),
                    F.lit(DEFAULT_OFFSET))


def local_label(ts: Column) -> Column:
    """Short display label of the local time, e.g. ``01 Jan 05:30 IST``."""
    return F.concat(F.date_format(utc_to_local(ts), "dd MMM HH:mm"), F.lit(" IST"))


def parse_offset_timestamp(text: Column, offset: Column, default: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text plus offset text to UTC.

    A missing offset means local time; text that does not parse gives ``default``.
    """
    joined = F.concat(text, F.coalesce(offset, F.lit(DEFAULT_OFFSET)))
    parsed = F.try_to_timestamp(joined, F.lit("yyyy-MM-dd HH:mm:ssXXX"))
    return F.coalesce(utc_wall(parsed), default.cast("timestamp_ntz"))


def city_key(city: Column) -> Column:
    """Path-safe key: lower case, spaces to underscores."""
    return F.regexp_replace(F.lower(city), " ", "_")


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")
