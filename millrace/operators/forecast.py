"""Daily forecasts for many series at once.

A series has one row per group and day, so a group is never larger than its
calendar. All windows below partition by the group (or by it and more), which
one shuffle by group serves.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: half width of a 95 % interval in standard deviations.
Z95 = 1.96

MODELS = ("last_value", "seasonal", "trend")


def daily_series(df: DataFrame, group: str, ts: str, value: str) -> DataFrame:
    """Sum per group and day, as ``(group, ds, y)``."""
    return df.groupBy(F.col(group).alias("group"), F.to_date(ts).alias("ds")).agg(F.sum(value).alias("y"))


def with_horizon(series: DataFrame, days: int) -> DataFrame:
    """The series and ``days`` rows without a value after each group's last day."""
    last = F.max("ds").over(Window.partitionBy("group"))
    own = F.array(F.struct(F.col("ds").alias("ds"), F.col("y").cast("double").alias("y")))
    ahead = F.transform(
        F.sequence(F.lit(1), F.lit(days)),
        lambda i: F.struct(F.date_add("ds", i).alias("ds"), F.lit(None).cast("double").alias("y")),
    )
    marked = series.dropna().withColumn("_last", last)
    rows = F.when(F.col("ds") == F.col("_last"), F.concat(own, ahead)).otherwise(own)
    return marked.select("group", rows.alias("_rows")).select("group", F.inline("_rows"))


def _components(rows: DataFrame, keys: Sequence[str] = ("group",)) -> DataFrame:
    """Linear trend, weekday factor and month factor of every row, future ones included."""
    group = Window.partitionBy(*keys)
    weekday = Window.partitionBy(*keys, "_weekday")
    month = Window.partitionBy(*keys, "_month")
    timed = rows.withColumns(
        {
            "_t": F.datediff("ds", F.min("ds").over(group)).cast("double"),
            "_weekday": F.dayofweek("ds"),
            "_month": F.month("ds"),
        }
    )
    known = F.when(F.col("y").isNotNull(), F.col("_t"))
    trended = timed.withColumn(
        "trend", F.regr_intercept("y", known).over(group) + F.regr_slope("y", known).over(group) * F.col("_t")
    )
    ratio = trended.withColumn("_r1", F.col("y") / F.nullif("trend", F.lit(0.0)))
    ratio = ratio.withColumn("_wf", F.avg("_r1").over(weekday))
    ratio = ratio.withColumn("_r2", F.col("_r1") / F.nullif("_wf", F.lit(0.0)))
    return ratio.withColumns(
        {
            "weekday_factor": F.coalesce("_wf", F.lit(1.0)),
            "month_factor": F.coalesce(F.avg("_r2").over(month), F.lit(1.0)),
        }
    )


def forecast(series: DataFrame, days: int, training_date: date) -> DataFrame:
    """History and future with a 95 % interval: trend times weekday times month."""
    fitted = _components(with_horizon(series, days)).withColumn(
        "yhat", F.col("trend") * F.col("weekday_factor") * F.col("month_factor")
    )
    sigma = F.stddev_samp(F.col("y") - F.col("yhat")).over(Window.partitionBy("group"))
    return fitted.withColumn("_sigma", sigma).select(
        "ds",
        "group",
        "y",
        "yhat",
        (F.col("yhat") + Z95 * F.col("_sigma")).alias("yhat_upper"),
        (F.col("yhat") - Z95 * F.col("_sigma")).alias("yhat_lower"),
        F.lit(training_date).alias("training_date"),
    )


def evaluate(forecasts: DataFrame) -> DataFrame:
    """MAE, MSE and RMSE per training date and group, over days with a known value."""
    error = F.col("y") - F.col("yhat")
    return (
        forecasts.where("y IS NOT NULL")
        .groupBy("training_date", "group")
        .agg(
            F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"), F.sqrt(F.avg(error * error)).alias("rmse")
        )
    )


def _relative_error(predicted: Column | str) -> Column:
    predicted = F.col(predicted) if isinstance(predicted, str) else predicted
    return F.abs((F.col("y") - predicted) / F.nullif("y", F.lit(0.0)))


def median_relative_error(forecasts: DataFrame) -> DataFrame:
    """Median absolute relative error per group; a group has at most one row per day."""
    return (
        forecasts.where("y IS NOT NULL")
        .groupBy("group")
        .agg(F.percentile(_relative_error("yhat"), F.lit(0.5)).alias("mdape"))
    )


def best_models(series: DataFrame) -> DataFrame:
    """Per group the candidate with the least median relative error over the history."""
    parts = _components(series.dropna().withColumn("y", F.col("y").cast("double")))
    previous = F.lag("y").over(Window.partitionBy("group").orderBy("ds"))
    candidates = {
        "last_value": previous,
        "seasonal": F.col("trend") * F.col("weekday_factor") * F.col("month_factor"),
        "trend": F.col("trend"),
    }
    errors = parts.select("group", "y", *[c.alias(n) for n, c in candidates.items()])
    scored = errors.groupBy("group").agg(
        *[F.percentile(_relative_error(n), F.lit(0.5)).alias(n) for n in candidates]
    )
    best = F.array_min(F.array(*[F.struct(F.col(n).alias("mdape"), F.lit(n).alias("model")) for n in candidates]))
    return scored.withColumn("_best", best).select("group", "_best.model", "_best.mdape", *candidates)


def rolling_errors(series: DataFrame, cutoffs: int = 3, days: int = 30) -> DataFrame:
    """Errors of the candidates on days they have not seen: ``group, cutoff, days, <model>`` with median relative errors.

    The last day of a group less one to ``cutoffs`` times ``days`` are its
    cut-off days. Up to each of them the candidates are fitted anew, and the
    ``days`` days after it judge them. A cut-off is one more key of the same
    windows, so a series is read once and each (group, cut-off) stays as large
    as its calendar. A cut-off with fewer than two days before it is left out.
    """
    whole = Window.partitionBy("group")
    known = series.dropna().withColumn("y", F.col("y").cast("double")).withColumn("_last", F.max("ds").over(whole))
    known = known.withColumn("_first", F.min("ds").over(whole))
    steps = F.transform(F.sequence(F.lit(1), F.lit(cutoffs)), lambda k: F.date_sub("_last", k * days))
    at = known.withColumn("cutoff", F.explode(F.filter(steps, lambda c: c > F.col("_first"))))
    at = at.where(F.col("ds") <= F.date_add("cutoff", days)).withColumnRenamed("y", "actual")
    at = at.withColumn("y", F.when(F.col("ds") <= F.col("cutoff"), F.col("actual")))
    keys = ["group", "cutoff"]
    parts = _components(at, keys)
    latest = F.max_by("y", F.when(F.col("y").isNotNull(), F.col("ds"))).over(Window.partitionBy(*keys))
    candidates = {"last_value": latest, "seasonal": F.col("trend") * F.col("weekday_factor") * F.col("month_factor"), "trend": F.col("trend")}
    unseen = parts.select(*keys, "ds", F.col("actual").alias("y"), *[c.alias(n) for n, c in candidates.items()]).where(F.col("ds") > F.col("cutoff"))
    errors = [F.percentile(_relative_error(n), F.lit(0.5)).alias(n) for n in candidates]
    return unseen.groupBy(*keys).agg(F.count("*").alias("days"), *errors)


def best_unseen(errors: DataFrame) -> DataFrame:
    """Per group the candidate of :func:`rolling_errors` with the least error, averaged over the cut-offs; ties go by name."""
    means = errors.groupBy("group").agg(F.count("*").alias("cutoffs"), *[F.avg(n).alias(n) for n in MODELS])
    ranked = F.array(*[F.struct(F.col(n).alias("mdape"), F.lit(n).alias("model")) for n in MODELS])
    best = F.array_min(F.filter(ranked, lambda m: m["mdape"].isNotNull()))
    return means.withColumn("_best", best).select("group", "_best.model", "_best.mdape", "cutoffs", *MODELS)


def broken_trend(series: DataFrame, days: int, breaks: int = 2, ridge: float = 1e-3) -> DataFrame:
    """History and future with a trend that bends at ``breaks`` even places and a band that widens ahead.

    Time runs from 0 to 1 over a group's history. The trend is a line and, for
    each break, a hinge that starts there; its weights solve the normal
    equations, whose entries are sums per group, so no task holds more than a
    group's calendar. Hinges are shrunk by ``ridge`` per row, the line is not.
    The residual's deviation is the band's start; each day ahead adds the
    variance of further bends as large as those seen: one bend a break's
    distance, each moving the trend by its size times the time since.
    Returns ``group, ds, y, yhat, yhat_upper, yhat_lower``.
    """
    rows = with_horizon(series, days)
    group = Window.partitionBy("group")
    last = F.max(F.when(F.col("y").isNotNull(), F.col("ds"))).over(group)
    first = F.min("ds").over(group)
    span = F.greatest(F.datediff(last, first), F.lit(1)).cast("double")
    timed = rows.withColumns({"_t": F.datediff("ds", first) / span, "_ahead": F.greatest(F.datediff("ds", last), F.lit(0)) / span})
    places = [(k + 1) / (breaks + 1) for k in range(breaks)]
    basis = {"_b0": F.lit(1.0), "_b1": F.col("_t"), **{f"_b{k + 2}": F.greatest(F.col("_t") - p, F.lit(0.0)) for k, p in enumerate(places)}}
    timed = timed.withColumns(basis)
    names, size = list(basis), len(basis)
    known = F.when(F.col("y").isNotNull(), 1.0)
    sums = {f"_g{i}{j}": F.sum(known * F.col(names[i]) * F.col(names[j])).over(group) for i in range(size) for j in range(i + 1)}
    sums |= {f"_r{i}": F.sum(known * F.col(names[i]) * F.col("y")).over(group) for i in range(size)}
    sums["_n"] = F.count("y").over(group)
    fitted = timed.withColumns(sums)
    # Cholesky's factor, column by column; a pivot of nothing (one day, no spread) leaves its weight at 0.
    for j in range(size):
        shrink = F.lit(ridge) * F.col("_n") if j >= 2 else F.lit(0.0)
        pivot = F.col(f"_g{j}{j}") + shrink - sum((F.col(f"_l{j}{k}") * F.col(f"_l{j}{k}") for k in range(j)), F.lit(0.0))
        fitted = fitted.withColumn(f"_l{j}{j}", F.when(pivot > 1e-12, F.sqrt(pivot)))
        for i in range(j + 1, size):
            rest = F.col(f"_g{i}{j}") - sum((F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}") for k in range(j)), F.lit(0.0))
            fitted = fitted.withColumn(f"_l{i}{j}", F.coalesce(rest / F.col(f"_l{j}{j}"), F.lit(0.0)))
    for i in range(size):
        rest = F.col(f"_r{i}") - sum((F.col(f"_l{i}{k}") * F.col(f"_z{k}") for k in range(i)), F.lit(0.0))
        fitted = fitted.withColumn(f"_z{i}", F.coalesce(rest / F.col(f"_l{i}{i}"), F.lit(0.0)))
    for i in reversed(range(size)):
        rest = F.col(f"_z{i}") - sum((F.col(f"_l{k}{i}") * F.col(f"_w{k}") for k in range(i + 1, size)), F.lit(0.0))
        fitted = fitted.withColumn(f"_w{i}", F.coalesce(rest / F.col(f"_l{i}{i}"), F.lit(0.0)))
    fitted = fitted.withColumn("yhat", sum((F.col(f"_w{i}") * F.col(n) for i, n in enumerate(names)), F.lit(0.0)))
    error = F.coalesce(F.var_samp(F.col("y") - F.col("yhat")).over(group), F.lit(0.0))
    bends = sum((F.col(f"_w{k}") * F.col(f"_w{k}") for k in range(2, size)), F.lit(0.0)) / max(1, breaks)
    # Bends come at a rate of one per distance; one at time u before the day moves it by its size times u.
    drift = bends * (breaks + 1) * F.pow("_ahead", 3) / 3
    width = Z95 * F.sqrt(error + drift)
    return fitted.withColumn("_width", width).select(
        "group", "ds", "y", "yhat", (F.col("yhat") + F.col("_width")).alias("yhat_upper"), (F.col("yhat") - F.col("_width")).alias("yhat_lower")
    )


def forecast_grouped_map(series: DataFrame, days: int, training_date: date, yearly: int = 3, weekly: int = 3) -> DataFrame:
    """The same output from a least-squares fit per group, with Fourier terms for week and year."""
    schema = "ds date, `group` string, y double, yhat double, yhat_upper double, yhat_lower double"

    def design(ordinal: np.ndarray, start: float) -> np.ndarray:
        t = ordinal - start
        columns = [np.ones_like(t), t]
        for period, order in ((365.25, yearly), (7.0, weekly)):
            for k in range(1, order + 1):
                columns += [np.sin(2 * np.pi * k * ordinal / period), np.cos(2 * np.pi * k * ordinal / period)]
        return np.column_stack(columns)

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ds")
        past = pd.to_datetime(frame["ds"])
        every = pd.concat([past, pd.Series(pd.date_range(past.iloc[-1] + pd.Timedelta(days=1), periods=days))])
        ordinal = every.map(pd.Timestamp.toordinal).to_numpy(dtype=float)
        x = design(ordinal, ordinal[0])
        y = frame["y"].to_numpy(dtype=float)
        weights, *_ = np.linalg.lstsq(x[: len(y)], y, rcond=None)
        yhat = x @ weights
        width = 1.96 * np.std(y - yhat[: len(y)], ddof=1) if len(y) > 1 else 0.0
        return pd.DataFrame(
            {
                "ds": every.dt.date.to_numpy(),
                "group": frame["group"].iloc[0],
                "y": np.concatenate([y, np.full(days, np.nan)]),
                "yhat": yhat,
                "yhat_upper": yhat + width,
                "yhat_lower": yhat - width,
            }
        )

    fitted = series.dropna(subset=["ds", "y"]).groupBy("group").applyInPandas(fit, schema)
    return fitted.withColumn("y", F.nanvl("y", F.lit(None))).withColumn("training_date", F.lit(training_date))
