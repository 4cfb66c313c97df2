"""Additive seasonal regression per series, fitted from distributed sufficient statistics.

Trend with hinge points, Fourier seasonalities and external regressors form one
feature vector per row, built from native expressions. Workers reduce their
Arrow batches to one Gram matrix per series; those matrices are added up by an
ordinary aggregation. Only the solve of a fixed-size system per series runs
on collected data.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.dimensions import REGRESSORS
from hourgrid.functions.index import clip_index

# functions of this module travel to the workers by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Z_95 = 1.959963984540054


@dataclass(frozen=True)
class SeasonalModel:
    """Shape of the model. Orders are Fourier orders, periods are in days.

    The daily cycle takes the higher of the two daily orders the model family
    asks for; a second set of the same period would only repeat its columns.
    """

    seasonalities: Sequence[tuple[float, int]] = ((1.0, 8), (7.0, 3), (365.25, 10), (365.25 / 4, 5))
    changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_prior: float = 0.05
    seasonality_prior: float = 10.0
    #: "normal": changes of the slope carry a ridge penalty; "laplace": an absolute one, so most of them are zero
    changepoint_shape: str = "normal"
    #: variance of the noise that absolute penalties are weighed against; fitted with the rest if None
    noise_variance: float | None = None
    regressors: Sequence[str] = field(default_factory=lambda: tuple(REGRESSORS))

    @property
    def width(self) -> int:
        return (2 + self.changepoints + 2 * sum(order for _, order in self.seasonalities)
                + len(self.regressors))

    def shape(self) -> str:
        """All that the meaning of the coefficients depends on, as text."""
        return json.dumps([[[float(p), n] for p, n in self.seasonalities], self.changepoints,
                           self.changepoint_range, list(self.regressors)])

    @classmethod
    def of_shape(cls, shape: str) -> SeasonalModel:
        seasonalities, changepoints, reach, regressors = json.loads(shape)
        return cls(tuple((p, n) for p, n in seasonalities), changepoints, reach, regressors=tuple(regressors))

    def penalties(self) -> np.ndarray:
        """Ridge weights: none on level and slope, ``1 / prior**2`` elsewhere; none on changes that have absolute ones."""
        seasonal = 2 * sum(order for _, order in self.seasonalities) + len(self.regressors)
        changes = 0.0 if self.changepoint_shape == "laplace" else self.changepoint_prior ** -2.0
        return np.concatenate([
            np.zeros(2), np.full(self.changepoints, changes),
            np.full(seasonal, self.seasonality_prior ** -2.0)])

    def absolute_penalties(self) -> np.ndarray:
        """Weights of absolute values, for noise of variance 1: ``1 / prior`` on changes that have a Laplace prior."""
        if self.changepoint_shape not in ("normal", "laplace"):
            raise ValueError("changepoint_shape must be normal or laplace")
        weights = np.zeros(self.width)
        if self.changepoint_shape == "laplace":
            weights[2:2 + self.changepoints] = 1.0 / self.changepoint_prior
        return weights

    def vector(self, ts: Column, time: Column) -> Column:
        """Feature vector of a row; ``time`` is 0..1 over the training range."""
        parts = [F.lit(1.0), time]
        for i in range(1, self.changepoints + 1):
            knot = self.changepoint_range * i / self.changepoints
            parts.append(F.greatest(F.lit(0.0), time - knot))
        days = F.unix_seconds(ts.cast("timestamp")) / 86400.0
        for period, order in self.seasonalities:
            for k in range(1, order + 1):
                angle = days * (2 * math.pi * k / period)
                parts += [F.sin(angle), F.cos(angle)]
        parts += [F.coalesce(F.col(r).cast("double"), F.lit(0.0)) for r in self.regressors]
        return F.array(*parts)


def _scaling(train: DataFrame, keys: Sequence[str], ts: str, y: str,
             regressors: Sequence[str]) -> DataFrame:
    """Per series: rows, time range, target scale, regressor means and deviations."""
    seconds = F.unix_seconds(F.col(ts).cast("timestamp")).cast("double")
    stats = [s for r in regressors for s in (
        F.coalesce(F.avg(r), F.lit(0.0)).alias(f"__m_{r}"),
        F.coalesce(F.nullif(F.stddev_pop(r), F.lit(0.0)), F.lit(1.0)).alias(f"__s_{r}"))]
    return train.filter(F.col(y).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(seconds).alias("__t0"), F.max(seconds).alias("__t1"),
        F.greatest(F.max(F.abs(F.col(y))), F.lit(1e-9)).alias("__scale"), *stats)


def _design(df: DataFrame, scaling: DataFrame, keys: Sequence[str], ts: str,
            model: SeasonalModel) -> DataFrame:
    """Rows with their feature vector ``__x`` and target scale; NULL regressors take the mean."""
    seconds = F.unix_seconds(F.col(ts).cast("timestamp")).cast("double")
    joined = df.join(scaling, list(keys))
    scaled = {r: F.coalesce((F.col(r).cast("double") - F.col(f"__m_{r}")) / F.col(f"__s_{r}"),
                            F.lit(0.0)) for r in model.regressors}
    time = (seconds - F.col("__t0")) / F.greatest(F.col("__t1") - F.col("__t0"), F.lit(1.0))
    return (joined.withColumn("__time", time)
            .withColumns({f"__raw_{r}": F.col(r) for r in model.regressors})
            .withColumns(scaled)
            .withColumn("__x", model.vector(F.col(ts), F.col("__time")))
            .withColumns({r: F.col(f"__raw_{r}") for r in model.regressors})
            .drop("__time", *[f"__raw_{r}" for r in model.regressors]))


def _partial_gram(width: int):
    """Per-partition reducer: rows of (key, x, y) to one flat ``[x y 1]' [x y 1]`` per key."""
    size = width + 1

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = np.asarray(batch.column(1).flatten()).reshape(-1, width)
            z = np.column_stack([x, batch.column(2).to_numpy(zero_copy_only=False)])
            codes, names = pd.factorize(batch.column(0).to_pandas())
            order = np.argsort(codes, kind="stable")
            cuts = np.flatnonzero(np.diff(codes[order])) + 1
            for part, name in zip(np.split(z[order], cuts), names):
                gram = part.T @ part
                sums[name] = sums[name] + gram if name in sums else gram
                rows[name] = rows.get(name, 0) + len(part)
                if len(sums) >= 256:
                    yield _gram_batch(sums, rows, size)
                    sums, rows = {}, {}
        if sums:
            yield _gram_batch(sums, rows, size)

    return reduce


def _gram_batch(sums: dict[str, np.ndarray], rows: dict[str, int], size: int) -> pa.RecordBatch:
    names = list(sums)
    upper = np.triu_indices(size)
    return pa.RecordBatch.from_arrays([
        pa.array(names, pa.string()), pa.array([rows[n] for n in names], pa.int64()),
        pa.array([sums[n][upper] for n in names], pa.list_(pa.float64()))],
        names=["__key", "__rows", "__gram"])


def solve_penalised(gram: np.ndarray, target: np.ndarray, ridge: np.ndarray, absolute: np.ndarray,
                    sweeps: int = 20_000, tolerance: float = 1e-12) -> np.ndarray:
    """The minimum of ``b'Gb/2 - t'b + ridge'b^2/2 + absolute'|b|``, from sums alone.

    Coefficients without an absolute weight are eliminated. The others go through coordinate
    descent; then the system of those that are not zero is solved as a whole with their signs,
    and taken if it meets the conditions of the minimum.
    """
    whole = gram + np.diag(ridge)
    sparse, free = np.flatnonzero(absolute > 0), np.flatnonzero(absolute == 0)
    if not len(sparse):
        return np.linalg.lstsq(whole, target, rcond=None)[0]
    # pseudo-inverse: level and slope may coincide on short series
    inner = np.linalg.pinv(whole[np.ix_(free, free)], hermitian=True)
    across = whole[np.ix_(sparse, free)]
    reduced = whole[np.ix_(sparse, sparse)] - across @ inner @ across.T
    wanted, weights = target[sparse] - across @ inner @ target[free], absolute[sparse]
    beta, size = np.zeros(len(sparse)), np.diag(reduced)
    usable = size > 1e-12 * max(np.abs(np.diag(gram)).max(), 1e-300)  # a change after the last row changes nothing
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero(usable):
            pull = wanted[j] - reduced[j] @ beta + size[j] * beta[j]
            new = math.copysign(max(abs(pull) - weights[j], 0.0), pull) / size[j]
            moved, beta[j] = max(moved, abs(new - beta[j])), new
        if moved <= tolerance * max(1.0, np.abs(beta).max()):
            break
    active = np.flatnonzero(beta)
    if len(active):
        exact = np.zeros(len(sparse))
        exact[active] = np.linalg.lstsq(reduced[np.ix_(active, active)], wanted[active] - weights[active] * np.sign(beta[active]), rcond=None)[0]
        slack = np.abs(wanted - reduced @ exact) <= weights * (1 + 1e-9) + 1e-9
        if (np.sign(exact) == np.sign(beta)).all() and slack[usable].all():
            beta = exact
    out = np.zeros(len(target))
    out[sparse], out[free] = beta, inner @ (target[free] - across.T @ beta)
    return out


def solve_with_noise(gram: np.ndarray, target: np.ndarray, square: float, rows: int, ridge: np.ndarray, absolute: np.ndarray,
                     variance: float | None, rounds: int = 50) -> tuple[np.ndarray, float]:
    """(coefficients, mean squared residual). Absolute weights grow with the variance of the noise.

    Without a given variance, coefficients and variance are fitted in turn, from the
    variance without absolute weights on, until it stays.
    """
    def residual(beta: np.ndarray) -> float:
        return max(square - 2 * beta @ target + beta @ gram @ beta, 0.0) / max(rows, 1)

    if variance is not None or not absolute.any():
        beta = solve_penalised(gram, target, ridge, absolute * (variance or 0.0))
        return beta, residual(beta)
    now = residual(solve_penalised(gram, target, ridge, np.zeros(len(target))))
    for _ in range(rounds):
        before, beta = now, solve_penalised(gram, target, ridge, absolute * now)
        now = residual(beta)
        if abs(now - before) <= 1e-9 * before:
            break
    return beta, now


def _solver(width: int, penalties: list[float], absolute: list[float], variance: float | None):
    @F.pandas_udf("coefficients array<double>, sigma double")
    def solve(grams: pd.Series, rows: pd.Series) -> pd.DataFrame:
        size = width + 1
        upper = np.triu_indices(size)
        out = []
        for flat, n in zip(grams, rows):
            full = np.zeros((size, size))
            full[upper] = flat
            full = full + np.triu(full, 1).T
            a, b, yy = full[:width, :width], full[:width, width], full[width, width]
            beta, error = solve_with_noise(a, b, yy, n, np.array(penalties), np.array(absolute), variance)
            out.append((beta.tolist(), math.sqrt(error)))
        return pd.DataFrame(out, columns=["coefficients", "sigma"])

    return solve


def gram_cells(train: DataFrame, scaling: DataFrame, keys: Sequence[str], ts: str, y: str,
               model: SeasonalModel) -> DataFrame:
    """(__key, __i, __v): the upper triangle of ``[x y]' [x y]`` of every series, cell by cell.

    Rows stay where they are; each task reduces its share of every series.
    """
    by = list(keys)
    rows = _design(train.filter(F.col(y).isNotNull()), scaling, by, ts, model).select(
        F.to_json(F.struct(*by)).alias("__key"), "__x",
        (F.col(y).cast("double") / F.col("__scale")).alias("__y"))
    partial = rows.mapInArrow(_partial_gram(model.width), "__key string, __rows bigint, __gram array<double>")
    cells = partial.select("__key", F.posexplode("__gram").alias("__i", "__v"))
    return cells.groupBy("__key", "__i").agg(F.sum("__v").alias("__v"))


def fit(train: DataFrame, keys: Sequence[str], ts: str = "ds", y: str = "y",
        model: SeasonalModel = SeasonalModel()) -> DataFrame:
    """One row per series: scaling values, ``coefficients``, the residual ``sigma`` and the ``shape``."""
    by = list(keys)
    scaling = _scaling(train, by, ts, y, model.regressors)
    whole = gram_cells(train, scaling, by, ts, y, model).groupBy("__key").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("__i", "__v"))), lambda s: s["__v"]).alias("__gram"))
    solve = _solver(model.width, [float(p) for p in model.penalties()], [float(p) for p in model.absolute_penalties()],
                    model.noise_variance)
    named = scaling.withColumn("__key", F.to_json(F.struct(*by)))
    return (named.join(whole, "__key").withColumn("__fit", solve("__gram", "__rows"))
            .withColumns({"coefficients": F.col("__fit.coefficients"), "sigma": F.col("__fit.sigma"),
                          "shape": F.lit(model.shape())})
            .drop("__fit", "__gram", "__key", "__rows"))


def predict(df: DataFrame, fitted: DataFrame, keys: Sequence[str], ts: str = "ds",
            model: SeasonalModel = SeasonalModel(), z: float = Z_95) -> DataFrame:
    """Add yhat, yhat_lower, yhat_upper; a native dot product with the joined coefficients.

    Fails on rows of ``fitted`` that were fitted with a model of another shape.
    """
    if "shape" in fitted.columns:
        same = F.col("shape") == model.shape()
        fitted = fitted.withColumn("coefficients", F.when(same, F.col("coefficients")).otherwise(F.raise_error(
            F.concat(F.lit("fitted with another shape: "), F.coalesce("shape", F.lit("none")))))).drop("shape")
    rows = _design(df, fitted, list(keys), ts, model)
    dot = F.aggregate(F.zip_with("__x", "coefficients", lambda a, b: a * b), F.lit(0.0),
                      lambda acc, v: acc + v)
    center, half = F.col("__yhat"), F.col("sigma") * F.col("__scale") * z
    return (rows.withColumn("__yhat", dot * F.col("__scale"))
            .withColumns({"yhat": clip_index(center), "yhat_lower": clip_index(center - half),
                          "yhat_upper": clip_index(center + half)})
            .select(*df.columns, "yhat", "yhat_lower", "yhat_upper"))


def regressor_availability(df: DataFrame, regressors: Sequence[str]) -> DataFrame:
    """Which candidate regressors have any value, in one pass, one row per regressor."""
    counts = df.agg(*[F.count(r).alias(r) for r in regressors])
    pairs = F.array(*[F.struct(F.lit(r).alias("regressor"), F.col(r).alias("non_null"))
                      for r in regressors])
    return counts.select(F.inline(pairs)).withColumn("available", F.col("non_null") > 0)


def assemble_regressors(df: DataFrame, keys: Sequence[str], ts: str,
                        regressors: Sequence[str]) -> DataFrame:
    """Scoring frame: NULL becomes the series mean (0 if it has none), absent columns 0."""
    present = [r for r in regressors if r in df.columns]
    means = df.groupBy(*keys).agg(*[F.avg(r).alias(f"__m_{r}") for r in present])
    filled = {r: F.coalesce(F.col(r).cast("double"), F.col(f"__m_{r}"), F.lit(0.0)) for r in present}
    filled |= {r: F.lit(0.0) for r in regressors if r not in present}
    return df.join(means, list(keys), "left").withColumns(filled).select(*keys, ts, *regressors)


def fill_with_train_mean(test: DataFrame, train: DataFrame, keys: Sequence[str],
                         regressors: Sequence[str]) -> DataFrame:
    """Test regressors with gaps filled from the training mean (NULL counted as 0 in training)."""
    means = train.groupBy(*keys).agg(
        *[F.avg(F.coalesce(F.col(r), F.lit(0.0))).alias(f"__m_{r}") for r in regressors])
    return (test.join(means, list(keys), "left")
            .withColumns({r: F.coalesce(F.col(r), F.col(f"__m_{r}"), F.lit(0.0)) for r in regressors})
            .drop(*[f"__m_{r}" for r in regressors]))
