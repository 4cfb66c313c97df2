"""Station discovery: active sensors, bounding boxes, freshness, consensus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.functions.index import pm25_to_aqi
from hourgrid.operators.lookups import rows_of_newest


def of_parameter(sensors: DataFrame, column: str, name: str = "pm25") -> DataFrame:
    return sensors.filter(F.lower(F.col(column)) == name)


def active_sensor(sensors: DataFrame, location: str, sensor: str) -> DataFrame:
    """Highest sensor id per location: the most recently registered one."""
    return sensors.groupBy(location).agg(F.max(sensor).alias(sensor),
                                         F.count(F.lit(1)).alias("candidates"))


def first_live_sensor(readings: DataFrame, location: str, sensor: str, ts: str,
                      since_year: int = 2024, position: str | None = None) -> DataFrame:
    """First sensor in list order whose newest reading is recent enough, per location."""
    rank = position or sensor
    newest = readings.groupBy(location, sensor).agg(
        F.max(ts).alias("__latest"), F.min(rank).alias("__rank"))
    live = newest.filter(F.year("__latest") >= since_year)
    return (live.groupBy(location)
            .agg(F.min(F.struct("__rank", F.col(sensor), "__latest")).alias("__s"))
            .select(location, F.col(f"__s.{sensor}").alias(sensor),
                    F.to_date("__s.__latest").alias("latest")))


def stations_in_boxes(places: DataFrame, stations: DataFrame, delta: float = 0.5,
                      place_lat: str = "lat", place_lon: str = "lon",
                      lat: str = "station_lat", lon: str = "station_lon") -> DataFrame:
    """Places with the stations inside ``±delta`` degrees.

    An equi-join on grid cells of side ``2 * delta`` (a box meets at most four)
    followed by the exact test, instead of comparing every pair.
    """
    side = 2.0 * delta

    def cell(x: Column) -> Column:
        return F.floor(x / side)

    def cells(low: Column, high: Column) -> Column:
        return F.sequence(cell(low), cell(high))

    boxed = (places.withColumn("__cy", F.explode(cells(F.col(place_lat) - delta, F.col(place_lat) + delta)))
             .withColumn("__cx", F.explode(cells(F.col(place_lon) - delta, F.col(place_lon) + delta))))
    located = stations.withColumns({"__cy": cell(F.col(lat)), "__cx": cell(F.col(lon))})
    inside = (F.col(lat).between(F.col(place_lat) - delta, F.col(place_lat) + delta)
              & F.col(lon).between(F.col(place_lon) - delta, F.col(place_lon) + delta))
    return boxed.join(located, ["__cy", "__cx"]).filter(inside).drop("__cy", "__cx")


def latest_per_sensor(readings: DataFrame, keys: Sequence[str], ts: str, value: str,
                      as_of: Column, days: int = 7, coverage: str | None = None) -> DataFrame:
    """Newest reading per sensor within the trailing days, with its age in hours and index.

    With ``coverage`` (a column) also that of the reading, 0 where it is unknown.
    """
    inside = readings.filter((F.col(ts) >= as_of - F.expr(f"INTERVAL {days} DAYS"))
                             & (F.col(ts) <= as_of))
    extra = [coverage] if coverage else []
    newest = rows_of_newest(inside, keys, ts).groupBy(*keys).agg(F.max(F.struct(ts, value, *extra)).alias("__r"))
    age = (F.unix_micros(as_of.cast("timestamp"))
           - F.unix_micros(F.col(f"__r.{ts}").cast("timestamp"))) / 3.6e9
    return newest.select(*keys, F.col(f"__r.{ts}").alias(ts), F.col(f"__r.{value}").alias(value),
                         age.alias("age_hours"), pm25_to_aqi(F.col(f"__r.{value}")).alias("aqi"),
                         *[F.coalesce(F.col(f"__r.{c}").cast("double"), F.lit(0.0)).alias(c) for c in extra])


def freshness(stations: DataFrame, latest: DataFrame, keys: Sequence[str], station: str,
              value: str) -> DataFrame:
    """Working and total stations per key, and the age of the newest reading."""
    joined = stations.select(*keys, station).join(latest, [*keys, station], "left")
    return joined.groupBy(*keys).agg(
        F.count(value).alias("working"), F.count(F.lit(1)).alias("total"),
        F.min("age_hours").alias("newest_age_hours"))


def consensus(readings: DataFrame, keys: Sequence[str], station: str, aqi: str,
              carry: Sequence[str] = ()) -> DataFrame:
    """Upper median over stations, the row of the station nearest to it, range and count.

    Stations are ranked within their key; a key is one place and hour, so its
    group is the number of stations there. Ties go to the smaller station id. One
    shuffle; the readings are not joined to themselves.
    """
    group = Window.partitionBy(*keys)
    whole = group.orderBy(aqi, station).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = readings.filter(F.col(aqi) > 0).withColumns({
        "__i": F.row_number().over(group.orderBy(aqi, station)) - 1, "stations_used": F.count(F.lit(1)).over(whole),
        "__lo": F.min(aqi).over(whole), "__hi": F.max(aqi).over(whole)})
    middle = F.when(F.col("__i") == F.floor(F.col("stations_used") / 2), F.col(aqi))
    ranked = ranked.withColumn("median_aqi", F.max(middle).over(whole))
    nearest = ranked.withColumn("__r", F.row_number().over(group.orderBy(
        F.abs(F.col(aqi) - F.col("median_aqi")), station, *carry))).filter(F.col("__r") == 1)
    return nearest.select(
        *keys, "median_aqi", "stations_used", F.concat_ws("-", "__lo", "__hi").alias("aqi_range"),
        F.col(station).alias("nearest_station"), *carry)
