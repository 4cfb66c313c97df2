"""A seasonal autoregressive moving-average baseline, fitted by two least-squares stages.

Series are differenced once, and once over a season. A long autoregression of the
differences estimates the shocks; a second regression explains the differences by their
own past and past shocks. Both stages need sums only: series are packed into time
buckets with a copied tail, every bucket is reduced to one Gram matrix, and an ordinary
aggregation adds these up. What is left per series is a solve of fixed size, and for a
forecast the newest observations that the lags reach.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.functions.index import clip_index
from hourgrid.functions.timefns import hour_number
from hourgrid.operators.features import BUCKET_HOURS, with_halo
from hourgrid.operators.regression import Z_95
from hourgrid.session import saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Orders:
    """Lags in observations. ``season`` is differenced; ``long`` lags estimate the shocks."""

    season: int = 24
    long: int = 50
    own: Sequence[int] = (1, 24, 25)
    shocks: Sequence[int] = (1, 24, 25)
    #: hours from one observation to the next
    step: int = 1
    #: missing observations in a row that take the value before; lags that meet longer gaps are undefined
    gap: int = 3

    @property
    def history(self) -> int:
        """Observations before a row that its second-stage features reach."""
        return self.gap + self.season + 1 + max([self.long, *self.own, *(self.long + s for s in self.shocks)])


def on_grid(hours: np.ndarray, values: np.ndarray, step: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """(grid of hours, values on it, NaN in long gaps); the largest value of an hour counts."""
    order = np.lexsort((values, hours))
    hours, values = hours[order], values[order]
    grid = np.arange(hours[0], hours[-1] + 1, step)
    out = np.full(len(grid), np.nan)
    on = (hours - hours[0]) % step == 0
    out[(hours[on] - hours[0]) // step] = values[on]
    return grid, pd.Series(out).ffill(limit=gap).to_numpy() if gap else out


def differences(y: np.ndarray, season: int) -> np.ndarray:
    out = np.full(len(y), np.nan)
    if len(y) > season + 1:
        out[season + 1:] = y[season + 1:] - y[season:-1] - y[1:-season] + y[:-season - 1]
    return out


def lagged(w: np.ndarray, lags: Sequence[int]) -> np.ndarray:
    """A column for each lag, NaN before the first value."""
    out = np.full((len(w), len(lags)), np.nan)
    for j, k in enumerate(lags):
        out[k:, j] = w[:max(len(w) - k, 0)]
    return out


def shocks_of(w: np.ndarray, long: np.ndarray) -> np.ndarray:
    return w - lagged(w, range(1, len(long) + 1)) @ long


def _packed(df: DataFrame, by: list[str], ts: str, y: str, orders: Orders, bucket_hours: int) -> DataFrame:
    """A row for each series and bucket: its hours and values, the copied tail of the bucket before among them."""
    known = df.filter(F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double"))).select(*by, ts, F.col(y).cast("double").alias("__y"))
    return with_halo(known, ts, orders.history * orders.step, bucket_hours).groupBy(*by, "__b").agg(
        F.collect_list("__h").alias("__hours"), F.collect_list("__y").alias("__values"), F.collect_list("__own").alias("__mine"))


def _gram(orders: Orders, stage: int):
    """The flat ``[x w]' [x w]`` of a bucket's own rows, behind the number of rows."""
    @F.pandas_udf("array<double>")
    def reduce(hours: pd.Series, values: pd.Series, mine: pd.Series, long: pd.Series) -> pd.Series:
        out = []
        for h, v, m, phi in zip(hours, values, mine, long):
            h, m = np.asarray(h, np.int64), np.asarray(m, bool)
            grid, y = on_grid(h, np.asarray(v, np.float64), orders.step, orders.gap)
            w = differences(y, orders.season)
            if stage == 1:
                x = lagged(w, range(1, orders.long + 1))
            else:
                x = np.column_stack([lagged(w, orders.own), lagged(shocks_of(w, np.asarray(phi)), orders.shocks)])
            z = np.column_stack([x, w])
            z = z[np.isin(grid, h[m]) & np.isfinite(z).all(axis=1)]
            out.append(np.concatenate([[len(z)], (z.T @ z)[np.triu_indices(z.shape[1])]]))
        return pd.Series(out)

    return reduce


def _solve(width: int):
    """Coefficients and residual deviation; zeros where rows are at most twice the coefficients."""
    @F.pandas_udf("coefficients array<double>, sigma double, rows long")
    def solve(cells: pd.Series) -> pd.DataFrame:
        out = []
        for flat in cells:
            n, full = int(flat[0]), np.zeros((width + 1, width + 1))
            full[np.triu_indices(width + 1)] = flat[1:]
            full = full + np.triu(full, 1).T
            gram, target, square = full[:width, :width], full[:width, width], full[width, width]
            beta = np.linalg.lstsq(gram, target, rcond=None)[0] if n > 2 * width else np.zeros(width)
            rest = max(square - 2 * beta @ target + beta @ gram @ beta, 0.0)
            out.append((beta.tolist(), math.sqrt(rest / n) if n else 0.0, n))
        return pd.DataFrame(out, columns=["coefficients", "sigma", "rows"])

    return solve


def _stage(packed: DataFrame, by: list[str], orders: Orders, stage: int) -> DataFrame:
    width = orders.long if stage == 1 else len(orders.own) + len(orders.shocks)
    long = F.col("long") if stage == 2 else F.array().cast("array<double>")
    cells = packed.select(*by, F.posexplode(_gram(orders, stage)("__hours", "__values", "__mine", long)).alias("__i", "__v"))
    summed = cells.groupBy(*by, "__i").agg(F.sum("__v").alias("__v")).groupBy(*by).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("__i", "__v"))), lambda s: s["__v"]).alias("__cells"))
    return summed.withColumn("__fit", _solve(width)("__cells")).select(*by, "__fit.*")


def fit(train: DataFrame, keys: Sequence[str], ts: str = "ds", y: str = "y", orders: Orders = Orders(),
        bucket_hours: int = BUCKET_HOURS) -> DataFrame:
    """(keys, long, coefficients, sigma, rows), a row for each series with a value.

    ``long`` are the first stage's coefficients, ``coefficients`` those of ``own`` and then
    ``shocks``, ``sigma`` the deviation of the second stage's residuals over its ``rows``.
    Rows whose lags meet a long gap are left out; filled values are no rows of their own. A stage with too few rows has zeros: the series
    then repeats its last season, moved to its level. Null and NaN values are gaps.
    """
    by = list(keys)
    packed = saved(_packed(train, by, ts, y, orders, bucket_hours), "arma-buckets")
    first = saved(_stage(packed, by, orders, 1).select(*by, F.col("coefficients").alias("long")), "arma-long")
    second = _stage(packed.join(first, by), by, orders, 2)
    return first.join(second, by)


def extend(y: np.ndarray, w: np.ndarray, e: np.ndarray, beta: np.ndarray, orders: Orders, steps: int) -> np.ndarray:
    """The next values of a series without further shocks. The arrays end at the same observation."""
    y, w, e = list(y), list(w), list(e)
    own, moved = beta[:len(orders.own)], beta[len(orders.own):]
    for _ in range(steps):
        now = sum(b * w[-k] for b, k in zip(own, orders.own)) + sum(b * e[-k] for b, k in zip(moved, orders.shocks))
        y.append(now + y[-1] + y[-orders.season] - y[-orders.season - 1])
        w.append(now)
        e.append(0.0)
    return np.array(y[-steps:])


def filled(y: np.ndarray) -> np.ndarray:
    """Gaps take the value before, or the first one there is."""
    return pd.Series(y).ffill().bfill().to_numpy()


def outlook(hours: np.ndarray, values: np.ndarray, long: np.ndarray, beta: np.ndarray, sigma: float, orders: Orders,
            steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, deviations) of the next steps of one series, from its newest observations."""
    size = orders.history + 1
    on = (hours.max() - hours) % orders.step == 0
    y = on_grid(hours[on], values[on], orders.step, orders.gap)[1][-size:]
    w = differences(np.concatenate([np.full(size - len(y), np.nan), y]), orders.season)
    e = np.nan_to_num(shocks_of(w, long))
    level = filled(y)
    level = np.concatenate([np.full(size - len(level), level[0]), level])
    path = extend(level, np.nan_to_num(w), e, beta, orders, steps)
    unit = np.zeros(size)
    unit[-1] = 1.0
    reply = np.concatenate([[1.0], extend(unit, unit, unit, beta, orders, steps)[:-1]])
    return path, sigma * np.sqrt(np.cumsum(reply ** 2))


def predict(train: DataFrame, fitted: DataFrame, keys: Sequence[str], steps: int, ts: str = "ds", y: str = "y",
            orders: Orders = Orders(), z: float = Z_95) -> DataFrame:
    """(keys, ds, yhat, yhat_lower, yhat_upper) of the ``steps`` observations after each series' last.

    Only the newest ``orders.history + 1`` observations of a series are read into a task.
    Gaps among them carry the value before them and count as no shock. Bands widen with the
    distance, as one shock goes on. Series without a row in ``fitted`` have no forecast.
    """
    by = list(keys)
    known = train.filter(F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double"))).select(
        *by, F.col(ts).alias("__ts"), F.col(y).cast("double").alias("__y"), hour_number(F.col(ts)).alias("__h"))
    newest = known.groupBy(*by).agg(F.max("__ts").alias("__last"), F.max("__h").alias("__top"))
    state = known.join(newest, by).filter(F.col("__h") > F.col("__top") - (orders.history + 1) * orders.step).groupBy(*by, "__last").agg(
        F.collect_list("__h").alias("__hours"), F.collect_list("__y").alias("__values"))

    @F.pandas_udf("array<struct<value: double, deviation: double>>")
    def ahead(hours: pd.Series, values: pd.Series, long: pd.Series, beta: pd.Series, sigma: pd.Series) -> pd.Series:
        out = []
        for h, v, phi, b, s in zip(hours, values, long, beta, sigma):
            path, spread = outlook(np.asarray(h, np.int64), np.asarray(v), np.asarray(phi), np.asarray(b), s, orders, steps)
            out.append([{"value": float(p), "deviation": float(d)} for p, d in zip(path, spread)])
        return pd.Series(out)

    rows = state.join(fitted, by).select(*by, "__last", F.posexplode(
        ahead("__hours", "__values", "long", "coefficients", "sigma")).alias("__n", "__f"))
    center, half = F.col("__f.value"), F.col("__f.deviation") * z
    when = F.col("__last") + F.make_dt_interval(hours=(F.col("__n") + 1) * orders.step)
    return rows.select(*by, when.alias("ds"), clip_index(center).alias("yhat"), clip_index(center - half).alias("yhat_lower"),
                       clip_index(center + half).alias("yhat_upper"))
