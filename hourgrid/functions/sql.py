"""The index functions under SQL names, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from hourgrid.dimensions import AQI_CATEGORIES, INDEX_CAP, PM25_BREAKPOINTS


def register(spark: SparkSession) -> None:
    """Define ``pm25_to_aqi(double)`` and ``aqi_category(double)`` for this session.

    Both are plain SQL bodies, so the optimizer inlines them.
    """
    bands = " ".join(
        f"WHEN v BETWEEN {c_lo!r}D AND {c_hi!r}D THEN"
        f" cast(rint((v - {c_lo!r}D) * {(i_hi - i_lo) / (c_hi - c_lo)!r}D + {i_lo}) AS INT)"
        for c_lo, c_hi, i_lo, i_hi in PM25_BREAKPOINTS)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION pm25_to_aqi(v DOUBLE) RETURNS INT RETURN"
              f" CASE WHEN v IS NULL THEN NULL WHEN v < 0 THEN 0 {bands} ELSE {INDEX_CAP} END")

    def one(label: str, color: str, advice: str) -> str:
        return f"named_struct('label', '{label}', 'color', '{color}', 'advice', '{advice}')"

    cases = " ".join(f"WHEN cast(v AS BIGINT) BETWEEN {low} AND {high} THEN {one(*rest)}"
                     for low, high, *rest in AQI_CATEGORIES)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION aqi_category(v DOUBLE)"
              " RETURNS STRUCT<label: STRING, color: STRING, advice: STRING> RETURN"
              f" CASE WHEN v IS NULL THEN NULL {cases} ELSE {one(*AQI_CATEGORIES[-1][2:])} END")
