"""Concentration-to-index conversion and index categories as native expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourgrid.dimensions import (
    AQI_CATEGORIES, CATEGORY_BOUNDARIES, INDEX_CAP, PM25_BREAKPOINTS)


def pm25_to_aqi(pm25: Column, gap: str = "cap") -> Column:
    """Piecewise-linear index of a concentration, rounded half to even.

    Below zero gives 0 and above the last band gives the cap. A value strictly
    between two bands also gives the cap (``gap="cap"``); with
    ``gap="truncate"`` it is first cut to one decimal, which closes the gaps.
    """
    if gap not in ("cap", "truncate"):
        raise ValueError("gap must be 'cap' or 'truncate'")
    v = pm25 if gap == "cap" else F.floor(pm25 * 10) / 10.0
    expr = F.when(pm25.isNull(), None).when(v < 0, 0)
    for c_lo, c_hi, i_lo, i_hi in PM25_BREAKPOINTS:
        line = (v - c_lo) * ((i_hi - i_lo) / (c_hi - c_lo)) + i_lo
        expr = expr.when(v.between(c_lo, c_hi), F.rint(line).cast("int"))
    return expr.otherwise(INDEX_CAP)


def _by_band(aqi: Column, position: int) -> Column:
    """Pick one attribute of the band a whole index value lies in."""
    whole = aqi.cast("bigint")
    bands = reduce(
        lambda acc, band: acc.when(whole.between(band[0], band[1]), band[position]),
        AQI_CATEGORIES, F.when(aqi.isNull(), None))
    return bands.otherwise(AQI_CATEGORIES[-1][position])


def aqi_label(aqi: Column) -> Column:
    """Category label; fractions are cut off, values outside every band are Severe."""
    return _by_band(aqi, 2)


def aqi_category(aqi: Column) -> Column:
    """Category as ``struct<label, color, advice>``."""
    return F.struct(aqi_label(aqi).alias("label"), _by_band(aqi, 3).alias("color"),
                    _by_band(aqi, 4).alias("advice"))


def display_color(aqi: Column) -> Column:
    """Colour by upper threshold only, without cutting off fractions."""
    expr = F.when(aqi.isNull(), None)
    for _, high, _, color, _ in AQI_CATEGORIES[:-1]:
        expr = expr.when(aqi <= high, color)
    return expr.otherwise(AQI_CATEGORIES[-1][3])


def near_boundary(aqi: Column, margin: float) -> Column:
    """True when the value lies within ``margin`` of a category boundary."""
    return F.least(*[F.abs(aqi - b) for b in CATEGORY_BOUNDARIES]) <= margin


def clip_index(x: Column) -> Column:
    """Clip to the valid index range, keeping NULL."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(0.0)), F.lit(float(INDEX_CAP))))


def whole_index(x: Column) -> Column:
    """Half-even rounding of a forecast to a whole index value."""
    return F.rint(x).cast("int")
