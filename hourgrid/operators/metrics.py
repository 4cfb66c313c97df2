"""Forecast metrics, calibration and evaluation reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.dimensions import BOUNDARY_MARGIN, MAE_ACCEPTANCE
from hourgrid.functions.index import aqi_label, near_boundary
from hourgrid.functions.timefns import rush_hour
from hourgrid.operators.quantiles import exact_quantiles


def split_by_time(df: DataFrame, keys: Sequence[str], ts: str = "ds", test_days: int = 7,
                  min_test_rows: int = 0, y: str = "y") -> DataFrame:
    """Label rows ``train`` or ``test`` (newer than the newest target minus ``test_days``).

    Series with fewer than ``min_test_rows`` test rows are labelled ``short``.
    """
    # looking at the target keeps the input the same as the row side's, so that an
    # hourly rollup below is shuffled once and shared
    newest = df.groupBy(*keys).agg(F.max(F.when(F.col(y).isNotNull(), F.col(ts))).alias("__newest"))
    cutoff = F.col("__newest") - F.expr(f"INTERVAL {test_days} DAYS")
    label = F.when(F.col(ts) > cutoff, "test").otherwise("train")
    out = df.join(newest, list(keys)).withColumn("split", label).drop("__newest")
    if min_test_rows:
        sizes = out.groupBy(*keys).agg(F.count_if(F.col("split") == "test").alias("__n"))
        out = (out.join(sizes, list(keys))
               .withColumn("split", F.when(F.col("__n") < min_test_rows, "short")
                           .otherwise(F.col("split"))).drop("__n"))
    return out


def _percent(condition: Column) -> Column:
    return F.avg(condition.cast("double")) * 100


def _mean_where(x: Column, where: Column) -> Column:
    return F.avg(F.when(where, x))


def regression_metrics(y: Column, yhat: Column) -> list[Column]:
    error = y - yhat
    return [
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.abs(error / (y + 1e-8))) * 100).alias("mape_eps"),
        (F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(1.0))) * 100).alias("mape_clip"),
    ]


def evaluate(df: DataFrame, keys: Sequence[str], ts: str = "ds", y: str = "y", yhat: str = "yhat",
             lower: str = "yhat_lower", upper: str = "yhat_upper",
             margin: float = BOUNDARY_MARGIN) -> DataFrame:
    """All scalar metrics of a forecast in one aggregation pass per series."""
    actual, predicted = F.col(y), F.col(yhat)
    same = aqi_label(actual) == aqi_label(predicted)
    near = near_boundary(actual, margin)
    covered = actual.between(F.col(lower), F.col(upper))
    error = F.abs(actual - predicted)
    one = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.to_date(F.min(ts)).alias("test_from"), F.to_date(F.max(ts)).alias("test_to"),
        *regression_metrics(actual, predicted),
        _percent(covered).alias("coverage_95"),
        _percent(same).alias("category_accuracy"),
        _percent(~same & near).alias("boundary_error_rate"),
        F.coalesce(_mean_where(same.cast("double"), ~near) * 100, F.lit(0.0))
        .alias("category_accuracy_ex_boundary"),
        F.coalesce(_mean_where(covered.cast("double"), ~near) * 100, F.lit(0.0))
        .alias("coverage_95_ex_boundary"),
        _mean_where(error, rush_hour(F.col(ts))).alias("rush_hour_mae"),
        F.avg(actual).alias("mean_actual_aqi"), F.avg(predicted).alias("mean_pred_aqi"))
    misses = F.greatest(F.lit(0.0), 100.0 - F.col("category_accuracy"))
    return one.withColumns({
        "calibration_gap": F.greatest(F.lit(0.0), 95.0 - F.col("coverage_95")),
        "boundary_share_of_errors": F.when(
            misses > 0, F.col("boundary_error_rate") / misses).otherwise(0.0),
    })


def calibration_bins(df: DataFrame, keys: Sequence[str], y: str = "y", lower: str = "yhat_lower",
                     upper: str = "yhat_upper", n_bins: int = 5, decimals: int | None = None) -> DataFrame:
    """Coverage by quantile bins of the interval width; bins without rows stay, with NULL.

    The last bin is closed on both sides, the others are open above. Widths are rounded to
    ``decimals``, if given, so that a row's bin does not hang on the last bit of a bound.
    """
    width = F.col(upper) - F.col(lower)
    rows = df.withColumn("__w", width if decimals is None else F.round(width, decimals))
    edges = exact_quantiles(rows, keys, "__w", [i / n_bins for i in range(n_bins + 1)], "__edges")
    inner = F.slice("__edges", 2, n_bins - 1)
    passed = F.size(F.filter(inner, lambda e: e <= F.col("__w")))
    counted = (rows.join(edges, list(keys)).withColumn("bin", passed + 1)
               .groupBy(*keys, "bin")
               .agg(F.count(F.lit(1)).alias("count"),
                    _percent(F.col(y).between(F.col(lower), F.col(upper))).alias("coverage")))
    frame = edges.select(*keys, "__edges", F.explode(F.sequence(F.lit(1), F.lit(n_bins))).alias("bin"))
    return (frame.join(counted, [*keys, "bin"], "left")
            .select(*keys, "bin", F.get("__edges", F.col("bin") - 1).alias("width_low"),
                    F.get("__edges", F.col("bin")).alias("width_high"),
                    F.coalesce("count", F.lit(0)).alias("count"), "coverage"))


def evaluation_report(df: DataFrame, keys: Sequence[str], **columns: str) -> DataFrame:
    """Scalar metrics plus the calibration bins as a nested array, one row per series."""
    bins = calibration_bins(df, keys, **{k: v for k, v in columns.items()
                                         if k in ("y", "lower", "upper")})
    nested = bins.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
        "bin", "width_low", "width_high", "count", "coverage"))).alias("calibration_bins"))
    return evaluate(df, keys, **columns).join(nested, list(keys), "left")


def average_row(report: DataFrame) -> DataFrame:
    """Unweighted mean over the series, and the acceptance verdict on the MAE."""
    return report.agg(
        F.count(F.lit(1)).alias("series"), F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"),
        F.avg("mape_clip").alias("mape_clip"), F.avg("coverage_95").alias("coverage_95"),
        F.coalesce(F.bool_and(F.col("mae") <= MAE_ACCEPTANCE), F.lit(True)).alias("all_passed"))


def split_metrics(df: DataFrame, keys: Sequence[str], y: str = "y", yhat: str = "yhat",
                  split: str = "split") -> DataFrame:
    """Train and test metrics side by side with their gaps, in one pass."""
    def pick(name: str) -> list[Column]:
        chosen = F.col(split) == name
        return [m.alias(f"{name}_{label}") for m, label in zip(
            regression_metrics(F.when(chosen, F.col(y)), F.when(chosen, F.col(yhat))),
            ("mae", "rmse", "mape", "mape_clip"))]
    both = df.groupBy(*keys).agg(*pick("train"), *pick("test"))
    gaps = {f"gap_{m}": F.col(f"test_{m}") - F.col(f"train_{m}") for m in ("mae", "rmse", "mape")}
    return both.withColumns(gaps).drop("train_mape_clip", "test_mape_clip")


def improvement(model: DataFrame, baseline: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Model against baseline MAE; NULL where a series has no baseline."""
    base = baseline.select(*keys, F.col("mae").alias("baseline_mae"))
    gain = F.try_divide(F.col("baseline_mae") - F.col("model_mae"), F.col("baseline_mae")) * 100
    return (model.select(*keys, F.col("mae").alias("model_mae")).join(base, list(keys), "left")
            .withColumn("improvement_pct", gain))
