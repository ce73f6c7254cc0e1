"""Additive daily forecasts: trend with change points plus yearly and weekly waves.

The fit is least squares with a normal prior per coefficient: loose for growth and
waves, tight for changes of the trend. Its curve is not that of any particular
forecasting library. The interval is the residual deviation times the normal
quantile of ``interval_width``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretide.functions.columns import finite
from caretide.functions.tails import normal_quantile
from caretide.operators import features as ft
from caretide.operators.schema import col
from caretide.operators.sequence import lag_and_rolling

YEAR, WEEK = 365.25, 7.0
YEAR_ORDER, WEEK_ORDER = 10, 3
CHANGE_POINTS, CHANGE_RANGE = 25, 0.8
# Prior deviations of the coefficients, and of the noise, as shares of the largest
# value. A column times its prior has a coefficient of prior deviation 1.
GROWTH_PRIOR, WAVE_PRIOR, CHANGE_PRIOR, NOISE = 5.0, 10.0, 0.05, 0.05


def prepare_series(df: DataFrame, target: str, date_column: str) -> DataFrame:
    """``(ds, y)`` in date order."""
    return df.select(
        F.to_date(col(date_column)).alias("ds"), finite(col(target)).alias("y")
    ).orderBy("ds")


def _waves() -> list[tuple[float, int]]:
    return [(YEAR, k) for k in range(1, YEAR_ORDER + 1)] + [(WEEK, k) for k in range(1, WEEK_ORDER + 1)]


def _hinges(count: int) -> list[float]:
    """Change points as shares of the history, evenly over its first part."""
    return [CHANGE_RANGE * (i + 1) / (count + 1) for i in range(count)]


@dataclass
class DailyForecaster:
    """A fitted curve for one daily series."""

    model: LinearRegressionModel
    start: date
    span: int
    scale: float
    sigma: float
    hinges: list[float]

    def _features(self, df: DataFrame) -> DataFrame:
        return _design(df, self.start, self.span, self.hinges)

    def forecast(self, history: DataFrame, periods: int = 30, interval_width: float = 0.80) -> DataFrame:
        """``(ds, yhat, yhat_lower, yhat_upper)`` for the history and ``periods`` more days."""
        last = history.agg(F.max("ds").alias("last"))
        ahead = last.select(
            F.explode(
                F.sequence(F.date_add("last", 1), F.date_add("last", F.lit(periods)))
            ).alias("ds")
        )
        days = history.select("ds")
        if periods > 0:
            days = days.unionByName(ahead)
        reach = normal_quantile((1 + interval_width) / 2) * self.sigma
        yhat = F.col("prediction") * F.lit(self.scale)
        return self.model.transform(self._features(days)).select(
            "ds",
            yhat.alias("yhat"),
            (yhat - F.lit(reach)).alias("yhat_lower"),
            (yhat + F.lit(reach)).alias("yhat_upper"),
        )


def _design(df: DataFrame, start: date, span: int, hinges: Sequence[float]) -> DataFrame:
    """Add the ``features`` vector; ``t`` is 0 at the start and 1 at the end of history."""
    days = F.datediff("ds", F.lit(start)).cast("double")
    t = days / F.lit(float(span))
    parts: list[Column] = [t * GROWTH_PRIOR]
    parts += [F.greatest(t - F.lit(h), F.lit(0.0)) * CHANGE_PRIOR for h in hinges]
    since = F.datediff("ds", F.lit(date(1970, 1, 1))).cast("double")
    for period, k in _waves():
        angle = since * F.lit(2 * math.pi * k / period)
        parts += [F.sin(angle) * WAVE_PRIOR, F.cos(angle) * WAVE_PRIOR]
    names = [f"__f{i}" for i in range(len(parts))]
    wide = df.select("*", *[p.alias(n) for p, n in zip(parts, names, strict=True)])
    return VectorAssembler(inputCols=names, outputCol="features").transform(wide).drop(*names)


def fit_forecast(daily: DataFrame, noise: float = NOISE) -> DailyForecaster:
    """Fit one series ``(ds, y)`` with one row per day."""
    known = daily.filter(F.col("y").isNotNull())
    start, end, n, scale = known.agg(
        F.min("ds"), F.max("ds"), F.count(F.lit(1)), F.max(F.abs("y"))
    ).first()
    if not n:
        raise ValueError("the series has no values")
    span, scale = max(1, (end - start).days), float(scale) or 1.0
    hinges = _hinges(min(CHANGE_POINTS, max(0, int(n * CHANGE_RANGE) - 1)))
    data = _design(known, start, span, hinges).withColumn("__y", F.col("y") / F.lit(scale))
    fit = LinearRegression(
        labelCol="__y",
        regParam=noise * noise / n,
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
    ).fit(data)
    sigma = math.sqrt(fit.summary.meanSquaredError) * scale
    return DailyForecaster(fit, start, span, scale, sigma, hinges)


def _fit_group(periods: int, width: float, noise: float):
    """Fit and extend one series held in one pandas group (one row per day)."""
    z = normal_quantile((1 + width) / 2)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        ds = pd.to_datetime(pdf["ds"])
        y = pdf["y"].to_numpy(dtype=float)
        start, span = ds.iloc[0], max(1, (ds.iloc[-1] - ds.iloc[0]).days)
        ahead = ds.iloc[-1] + pd.to_timedelta(np.arange(1, periods + 1), unit="D")
        days = pd.DatetimeIndex(ds).append(pd.DatetimeIndex(ahead))
        hinges = _hinges(min(CHANGE_POINTS, max(0, int(len(y) * CHANGE_RANGE) - 1)))
        t = (days - start).days.to_numpy() / span
        since = (days - pd.Timestamp(0)).days.to_numpy()
        columns = [np.ones_like(t), t * GROWTH_PRIOR]
        columns += [np.maximum(t - h, 0) * CHANGE_PRIOR for h in hinges]
        for period, k in _waves():
            angle = 2 * np.pi * k / period * since
            columns += [np.sin(angle) * WAVE_PRIOR, np.cos(angle) * WAVE_PRIOR]
        design = np.stack(columns, 1)
        scale = np.abs(y).max() or 1.0
        known = design[: len(y)]
        ridge = noise * noise * np.eye(design.shape[1])
        ridge[0, 0] = 0.0
        beta = np.linalg.lstsq(known.T @ known + ridge, known.T @ (y / scale), rcond=None)[0]
        yhat = design @ beta * scale
        reach = z * np.sqrt(np.mean((y - yhat[: len(y)]) ** 2))
        return pd.DataFrame(
            {
                "series": pdf["series"].iloc[0],
                "ds": days.date,
                "yhat": yhat,
                "yhat_lower": yhat - reach,
                "yhat_upper": yhat + reach,
            }
        )

    return run


def forecast_many(
    daily: DataFrame,
    periods: int = 30,
    interval_width: float = 0.80,
    noise: float = NOISE,
) -> DataFrame:
    """Forecasts of many series ``(series, ds, y)``.

    Several values of a day are averaged first, so a group holds one row per day
    and is bounded by the calendar; the series spread over tasks.
    """
    kind = dict(daily.dtypes)["series"]
    return (
        daily.filter("y is not null and ds is not null")
        .groupBy("series", "ds")
        .agg(F.avg("y").alias("y"))
        .groupBy("series")
        .applyInPandas(
            _fit_group(periods, interval_width, noise),
            f"series {kind}, ds date, yhat double, yhat_lower double, yhat_upper double",
        )
    )


def boosted_features(daily: DataFrame, extra: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Lag, rolling and calendar features of ``(ds, y)``; rows without history are dropped.

    Rolling values are shifted by a day, so a row never sees its own target.
    """
    shifted = lag_and_rolling(daily, ["y"], ["ds"], lags=(1, 3, 7, 14), windows=(), daily=True)
    past = lag_and_rolling(
        shifted.withColumnRenamed("y_lag1", "past"), ["past"], ["ds"], lags=(), windows=(3, 7), daily=True
    )
    calendar = ft.cyclical_features(ft.temporal_features(past, "ds", holidays=()))
    names = ["past", "y_lag3", "y_lag7", "y_lag14"]
    names += [c for c in calendar.columns if c.startswith("past_rolling_")]
    names += ["day_of_week", "month", "is_weekend", "day_of_week_sin", "day_of_week_cos"]
    names += list(extra)
    return calendar.na.drop(subset=names), names


def boosted_forecast(
    daily: DataFrame, train_until: str, extra: Sequence[str] = (), **params
) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees on the past of a daily series; (model, ``(ds, y, yhat)`` after the split)."""
    data, names = boosted_features(daily, extra)
    before = F.col("ds") <= F.lit(train_until).cast("date")
    trees = GBTRegressor(
        **{"labelCol": "y", "maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8,
           "seed": 42, **params}
    )
    stages = [VectorAssembler(inputCols=names, outputCol="features"), trees]
    model = Pipeline(stages=stages).fit(data.filter(before))
    return model, model.transform(data.filter(~before)).select(
        "ds", "y", F.col("prediction").alias("yhat")
    )
