"""Row filters, coercion, renames, unit fixes and provenance."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.dimensions import (
    CITY_ALIASES, KMH_PER_MS, MIN_COVERAGE_PCT, PM25_MAX, PM25_MIN, WEATHER_RENAMES,
    WIND_KMH_MEAN)


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def quality_filter(df: DataFrame, value: str, coverage: str, flagged: str,
                   min_coverage: float = MIN_COVERAGE_PCT) -> DataFrame:
    """Keep readings that have a value, enough coverage and no flag.

    Missing coverage counts as complete, a missing flag as not flagged.
    """
    return df.filter(
        F.col(value).isNotNull()
        & (F.coalesce(F.col(coverage), F.lit(100.0)) >= min_coverage)
        & ~F.coalesce(F.col(flagged), F.lit(False)))


def physical_bounds(df: DataFrame, value: str, low: float = PM25_MIN,
                    high: float = PM25_MAX) -> DataFrame:
    return df.filter(F.col(value).between(low, high))


def canonical_name(name: Column, aliases: Sequence[tuple[str, str]] = CITY_ALIASES) -> Column:
    """The canonical name of an accepted spelling, else NULL.

    The alias list is fixed and short, so it is a literal map, not a join.
    """
    table = F.create_map(*[F.lit(x) for pair in aliases for x in pair])
    return F.try_element_at(table, F.lower(F.trim(name)))


def normalise_aliases(df: DataFrame, column: str,
                      aliases: Sequence[tuple[str, str]] = CITY_ALIASES) -> DataFrame:
    """Replace accepted spellings by the canonical name and drop unknown names."""
    return df.withColumn(column, canonical_name(F.col(column), aliases)).filter(F.col(column).isNotNull())


def coerce(df: DataFrame, numbers: Iterable[str] = (), timestamps: Mapping[str, str] | None = None,
           required: Sequence[str] = ()) -> DataFrame:
    """Parse text columns; what does not parse becomes NULL, required NULLs are dropped.

    ``timestamps`` maps a column to its pattern; an empty pattern means ISO text.
    """
    parsed = {c: nan_to_null(F.col(c).try_cast("double")) for c in numbers}
    for c, pattern in (timestamps or {}).items():
        text = F.col(c)
        stamp = F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)
        parsed[c] = stamp.cast("timestamp_ntz")
    out = df.withColumns(parsed) if parsed else df
    return out.dropna(subset=list(required)) if required else out


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Schema check only; reads no data."""
    return [c for c in required if c not in df.columns]


def keep_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def with_missing_as_null(df: DataFrame, columns: Sequence[str], dtype: str = "double") -> DataFrame:
    absent = {c: F.lit(None).cast(dtype) for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


def rename_weather(df: DataFrame, renames: Mapping[str, str] = WEATHER_RENAMES) -> DataFrame:
    return df.withColumnsRenamed(dict(renames))


def kmh_to_ms(col: Column) -> Column:
    return col / KMH_PER_MS


def wind_unit_fix(df: DataFrame, keys: Sequence[str], column: str = "wind_speed_10m",
                  threshold: float = WIND_KMH_MEAN) -> DataFrame:
    """Divide a whole series by 3.6 when its mean says it was recorded in km/h.

    The mean comes from a map-side-combined aggregate joined back, so a large
    series is never sorted or buffered in one task as a key-wide window would.
    """
    means = df.groupBy(*keys).agg(F.avg(column).alias("__mean"))
    fixed = F.when(F.col("__mean") > threshold, kmh_to_ms(F.col(column))).otherwise(F.col(column))
    return df.join(means, list(keys), "left").withColumn(column, fixed).drop("__mean")


def fill_with_series_mean(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                          last_resort: float | None = None) -> DataFrame:
    """Replace NULLs by the mean of the series (then by ``last_resort``, if given)."""
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(f"__m_{c}") for c in columns])
    filled = {}
    for c in columns:
        chain = [F.col(c), F.col(f"__m_{c}")]
        if last_resort is not None:
            chain.append(F.lit(last_resort))
        filled[c] = F.coalesce(*chain)
    return (df.join(means, list(keys), "left").withColumns(filled)
            .drop(*[f"__m_{c}" for c in columns]))


def provenance(df: DataFrame, value: str, source: str) -> DataFrame:
    """Constant provenance columns of one-value sources (``history`` or ``live``)."""
    location = {"history": 0, "live": -1}[source]
    v = F.col(value).cast("double")
    return df.withColumns({
        "pm25": v, "pm25_min": v, "pm25_max": v,
        "pm25_sd": F.lit(0.0), "coverage_pct": F.lit(100.0),
        "location_id": F.lit(location).cast("bigint"),
    })


def column_coverage(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Percentage of non-null values per series and column, one row each."""
    wide = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{c}") for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n"))
                      for c in columns])
    return (wide.select(*keys, "rows", F.inline(pairs))
            .select(*keys, "rows", "column", "n",
                    (F.col("n") * 100.0 / F.col("rows")).alias("coverage_pct")))
