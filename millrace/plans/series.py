"""Feature-table and forecasting queries."""

from __future__ import annotations

from datetime import date

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from millrace import sinks
from millrace.operators import budget
from millrace.operators import features as feat
from millrace.operators import forecast as fc
from millrace.operators.classify import hash_split
from millrace.operators.merge import merge_partitions
from millrace.plans.registry import checked, query

# ---- features --------------------------------------------------------------

_PICKUP = """(WITH w AS (SELECT event_type AS zip, value,
                 unnest([time_bucket(INTERVAL 15 MINUTE, ts) + to_minutes(15 * k) FOR k IN [1, 2, 3, 4]]) AS w_end FROM events)
     SELECT zip, epoch(w_end)::INTEGER AS ts, strftime(w_end, '%Y-%m') AS yyyy_mm,
            round(avg(value)::FLOAT::DOUBLE, 4) AS mean_fare, count(*)::INTEGER AS trips FROM w GROUP BY zip, w_end)"""

_DROPOFF = """(WITH w AS (SELECT event_type AS zip, time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS w_end FROM events)
     SELECT zip, epoch(w_end)::INTEGER AS ts, strftime(w_end, '%Y-%m') AS yyyy_mm, count(*)::INTEGER AS trips_30m,
            (dayofweek((w_end AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') IN (0, 6))::INTEGER AS weekend
     FROM w GROUP BY zip, w_end)"""


def _pickup(t):
    return feat.pickup_features(t.events, "event_type", "ts", "value")


def _dropoff(t):
    return feat.dropoff_features(t.events, "event_type", "ts")


def _short_pickup(df):
    mean = F.round(F.col("mean_fare_window_1h_pickup_zip").cast("double"), 4)
    return df.withColumn("mean_fare_window_1h_pickup_zip", mean).withColumnsRenamed(
        {"mean_fare_window_1h_pickup_zip": "mean_fare", "count_trips_window_1h_pickup_zip": "trips"}
    )


def _short_dropoff(df):
    return df.withColumnsRenamed({"count_trips_window_30m_dropoff_zip": "trips_30m", "dropoff_is_weekend": "weekend"})


@query("pickup_features", f"SELECT * FROM {_PICKUP}")
def pickup_features(t):
    return _short_pickup(_pickup(t))


@query("dropoff_features", f"SELECT * FROM {_DROPOFF}")
def dropoff_features(t):
    return _short_dropoff(_dropoff(t))


@query("feature_table", f"SELECT * FROM {_PICKUP} WHERE yyyy_mm = '2024-01'")
def feature_table(t):
    path = t.workspace().path("pickup_features")
    feat.write_feature_table(_pickup(t), path, ["zip", "ts"], "yyyy_mm")
    return _short_pickup(t.spark.read.parquet(path).where("yyyy_mm = '2024-01'"))


def _lookup_sql(rounding: str) -> str:
    return f"""WITH e AS (SELECT event_id, event_type, value, {rounding}(epoch_us(ts) / (15 * 60 * 1e6))::BIGINT * 900 AS r15,
                            {rounding}(epoch_us(ts) / (30 * 60 * 1e6))::BIGINT * 1800 AS r30 FROM events)
               SELECT event_id, value, r15, r30, mean_fare, trips, trips_30m, weekend FROM e
               LEFT JOIN {_PICKUP} AS p ON p.zip = event_type AND p.ts = r15
               LEFT JOIN {_DROPOFF} AS d ON d.zip = event_type AND d.ts = r30"""


def _training(t, as_of: str):
    trips = t.events.select("event_id", "event_type", "ts", "value")
    return feat.training_set(trips, "event_type", "ts", "ts", _pickup(t), _dropoff(t), as_of)


def _short_training(df):
    named = _short_dropoff(_short_pickup(df)).withColumnsRenamed(
        {"rounded_pickup_datetime": "r15", "rounded_dropoff_datetime": "r30"}
    )
    return named.select("event_id", "value", "r15", "r30", "mean_fare", "trips", "trips_30m", "weekend")


@query("feature_lookup", _lookup_sql("ceil"))
def feature_lookup(t):
    return _short_training(_training(t, "ceil"))


@query("feature_lookup_floor", _lookup_sql("floor"))
def feature_lookup_floor(t):
    return _short_training(_training(t, "floor"))


@checked(
    "regress_features",
    "SELECT model, true AS fitted FROM (VALUES ('linear'), ('boosted_trees')) AS v(model), (SELECT count(*) FROM events) AS e",
    # Values carry little signal; a model that went astray would miss by several deviations.
    lambda rows: rows.select("model", (F.greatest("validation_rmse", "test_rmse") < 2 * F.col("label_stddev")).alias("fitted")),
)
def regress_features(t):
    rows, train, test = _regression_sets(t)
    evaluator = RegressionEvaluator(metricName="rmse")
    linear, trees = LinearRegression(), GBTRegressor(maxIter=5, seed=42)
    searches = {
        "linear": (linear, ParamGridBuilder().addGrid(linear.regParam, [0.0, 0.1, 1.0]).build()),
        "boosted_trees": (trees, ParamGridBuilder().addGrid(trees.maxDepth, [2, 4]).build()),
    }
    found = []
    for name, (estimator, grid) in searches.items():
        search = TrainValidationSplit(
            estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, trainRatio=0.75, seed=42, parallelism=4
        ).fit(train)
        found.append((name, float(min(search.validationMetrics)), float(evaluator.evaluate(search.transform(test)))))
    errors = t.spark.createDataFrame(found, "model string, validation_rmse double, test_rmse double")
    spread = rows.agg(F.stddev_samp("label")).scalar()
    return errors.withColumn("label_stddev", spread)


def _regression_sets(t):
    """Rows of the training set with their label, and the parts to fit and to test on."""
    names = [
        "mean_fare_window_1h_pickup_zip",
        "count_trips_window_1h_pickup_zip",
        "count_trips_window_30m_dropoff_zip",
        "dropoff_is_weekend",
    ]
    found = _training(t, "floor").select("event_id", F.col("value").alias("label"), *[F.col(n).cast("double") for n in names])
    rows = t.workspace().keep(found, "training_set")
    filled = Imputer(inputCols=names, outputCols=names, strategy="mean").fit(rows).transform(rows)
    ready = VectorAssembler(inputCols=names, outputCol="features").transform(filled)
    train, test = hash_split(ready, "event_id", [80, 20])
    return rows, train, test


#: Seconds that the search of ``regress_budget`` may take.
_BUDGET = 300.0


@checked(
    "regress_budget",
    """SELECT candidate, true AS consistent
       FROM (SELECT 'linear ' || r AS candidate FROM (VALUES ('0.0'), ('0.01'), ('0.1'), ('1.0')) AS v(r)
             UNION ALL SELECT 'boosted trees ' || d || ' x ' || n FROM (VALUES ('2'), ('4')) AS v(d), (VALUES ('5'), ('10')) AS w(n)),
            (SELECT count(*) FROM events) AS e""",
    # What the time allowed differs from run to run; a candidate has an error exactly when it was tried, and the best has the least.
    lambda rows: rows.select(
        "candidate",
        (
            ((F.col("status") == "tried") == F.col("validation_rmse").isNotNull())
            & (F.col("validation_rmse").isNull() | (F.col("best_validation_rmse") <= F.col("validation_rmse")))
            & (F.col("best_validation_rmse").isNull() | (F.col("best_test_rmse") < 2 * F.col("label_stddev")))
        ).alias("consistent"),
    ),
)
def regress_budget(t):
    """Linear models and boosted trees, cheapest first, until the budget is used up; errors of all that were tried."""
    rows, train, test = _regression_sets(t)
    space = t.workspace()
    fit, validate = hash_split(train, "event_id", [75, 25], seed=7)
    fit, validate = space.keep(fit, "fit"), space.keep(validate, "validate")
    candidates = [(f"linear {r}", LinearRegression(regParam=r, solver="normal")) for r in (0.0, 0.01, 0.1, 1.0)]
    candidates += [
        (f"boosted trees {d} x {n}", GBTRegressor(maxDepth=d, maxIter=n, seed=42)) for d in (2, 4) for n in (5, 10)
    ]
    evaluator = RegressionEvaluator(metricName="rmse")
    best, found = budget.search(candidates, fit, validate, evaluator, _BUDGET)
    tested = None if best is None else float(evaluator.evaluate(best.transform(test)))
    least = min((f["error"] for f in found if f["error"] is not None), default=None)
    errors = t.spark.createDataFrame(
        [(f["place"], f["candidate"], f["passes"], f["status"], f["error"], least, tested) for f in found],
        "place int, candidate string, passes int, status string, validation_rmse double, best_validation_rmse double, best_test_rmse double",
    )
    return errors.withColumn("label_stddev", rows.agg(F.stddev_samp("label")).scalar())


# ---- forecasts -------------------------------------------------------------

_RUN = date(2024, 2, 1)
_DAYS = 90

_SERIES = """SELECT p_brand AS "group", l_shipdate::DATE AS ds, sum(l_quantity) AS y
             FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL"""

_FITTED = f"""s AS ({_SERIES}),
  b AS (SELECT "group", min(ds) AS first_ds, max(ds) AS last_ds FROM s GROUP BY 1),
  c AS (SELECT "group", regr_intercept(y, date_diff('day', first_ds, ds)) AS a, regr_slope(y, date_diff('day', first_ds, ds)) AS k
        FROM s JOIN b USING ("group") GROUP BY 1),
  r1 AS (SELECT s."group", ds, y, a + k * date_diff('day', first_ds, ds) AS trend,
                y / nullif(a + k * date_diff('day', first_ds, ds), 0) AS r1
         FROM s JOIN b USING ("group") JOIN c USING ("group")),
  wf AS (SELECT "group", dayofweek(ds) AS d, avg(r1) AS wf FROM r1 GROUP BY ALL),
  r2 AS (SELECT r1.*, r1 / nullif(wf, 0) AS r2 FROM r1 JOIN wf ON wf."group" = r1."group" AND d = dayofweek(ds)),
  mf AS (SELECT "group", month(ds) AS m, avg(r2) AS mf FROM r2 GROUP BY ALL),
  days AS (SELECT "group", ds, y FROM s UNION ALL
           SELECT "group", (last_ds + CAST(i AS INTEGER))::DATE, NULL FROM b, range(1, {_DAYS + 1}) AS g(i)),
  f AS (SELECT days."group", days.ds, days.y, (a + k * date_diff('day', first_ds, days.ds)) AS trend,
               (a + k * date_diff('day', first_ds, days.ds)) * coalesce(wf, 1) * coalesce(mf, 1) AS yhat
        FROM days JOIN b ON b."group" = days."group" JOIN c ON c."group" = days."group"
        LEFT JOIN wf ON wf."group" = days."group" AND wf.d = dayofweek(days.ds)
        LEFT JOIN mf ON mf."group" = days."group" AND mf.m = month(days.ds)),
  g AS (SELECT "group", stddev_samp(y - yhat) AS sigma FROM f GROUP BY 1)"""

_FORECAST = f"""WITH {_FITTED}
  SELECT ds, f."group", round(y, 2) AS y, round(yhat, 4) AS yhat, round(yhat + 1.96 * sigma, 4) AS yhat_upper,
         round(yhat - 1.96 * sigma, 4) AS yhat_lower, DATE '2024-02-01' AS training_date
  FROM f JOIN g ON g."group" = f."group" """


def _series(t):
    """Quantity per brand and day."""
    brands = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return fc.daily_series(brands, "p_brand", "l_shipdate", "l_quantity")


def _forecast(t):
    return fc.forecast(_series(t), _DAYS, _RUN)


def _rounded(df):
    return df.withColumns({"y": F.round("y", 2), **{c: F.round(c, 4) for c in ("yhat", "yhat_upper", "yhat_lower")}})


@query("series_history", _SERIES.replace("sum(l_quantity)", "round(sum(l_quantity), 2)"))
def series_history(t):
    return _series(t).withColumn("y", F.round("y", 2))


@query("forecast_daily", _FORECAST)
def forecast_daily(t):
    return _rounded(_forecast(t))


@query(
    "forecast_eval",
    f"""WITH {_FITTED} SELECT DATE '2024-02-01' AS training_date, "group", round(avg(abs(y - yhat)), 4) AS mae,
               round(avg((y - yhat) * (y - yhat)), 4) AS mse, round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse
        FROM f WHERE y IS NOT NULL GROUP BY "group" """,
)
def forecast_eval(t):
    return fc.evaluate(_forecast(t)).withColumns({c: F.round(c, 4) for c in ("mae", "mse", "rmse")})


@query(
    "forecast_mdape",
    f"""WITH {_FITTED} SELECT "group", round(quantile_cont(abs((y - yhat) / nullif(y, 0)), 0.5), 4) AS mdape
        FROM f WHERE y IS NOT NULL GROUP BY "group" """,
)
def forecast_mdape(t):
    return fc.median_relative_error(_forecast(t)).withColumn("mdape", F.round("mdape", 4))


@query(
    "forecast_select",
    f"""WITH {_FITTED}, h AS (SELECT *, lag(y) OVER (PARTITION BY "group" ORDER BY ds) AS prev FROM f WHERE y IS NOT NULL),
        e AS (SELECT "group", quantile_cont(abs((y - prev) / nullif(y, 0)), 0.5) AS last_value,
                     quantile_cont(abs((y - yhat) / nullif(y, 0)), 0.5) AS seasonal,
                     quantile_cont(abs((y - trend) / nullif(y, 0)), 0.5) AS trend FROM h GROUP BY 1)
        SELECT "group", CASE least(last_value, seasonal, trend) WHEN last_value THEN 'last_value'
                             WHEN seasonal THEN 'seasonal' ELSE 'trend' END AS model,
               round(least(last_value, seasonal, trend), 4) AS mdape, round(last_value, 4) AS last_value,
               round(seasonal, 4) AS seasonal, round(trend, 4) AS trend FROM e""",
)
def forecast_select(t):
    best = fc.best_models(_series(t))
    return best.withColumns({c: F.round(c, 4) for c in ("mdape", *fc.MODELS)})


_ROLLING = f"""s AS ({_SERIES}),
  b AS (SELECT "group", min(ds) AS first_ds, max(ds) AS last_ds FROM s GROUP BY 1),
  k AS (SELECT "group", first_ds, (last_ds - 30 * i::INTEGER)::DATE AS cutoff FROM b, range(1, 4) AS g(i) WHERE last_ds - 30 * i::INTEGER > first_ds),
  x AS (SELECT s."group", cutoff, ds, y AS actual, CASE WHEN ds <= cutoff THEN y END AS y, date_diff('day', first_ds, ds) AS d
        FROM s JOIN k ON s."group" = k."group" AND ds <= cutoff + 30),
  c AS (SELECT "group", cutoff, regr_intercept(y, d) AS a, regr_slope(y, d) AS b, arg_max(y, ds) FILTER (y IS NOT NULL) AS last_value FROM x GROUP BY ALL),
  r1 AS (SELECT x.*, a + b * d AS trend, y / nullif(a + b * d, 0) AS r1, last_value FROM x JOIN c USING ("group", cutoff)),
  r2 AS (SELECT *, avg(r1) OVER (PARTITION BY "group", cutoff, dayofweek(ds)) AS wf FROM r1),
  r3 AS (SELECT *, avg(r1 / nullif(wf, 0)) OVER (PARTITION BY "group", cutoff, month(ds)) AS mf FROM r2),
  e AS (SELECT "group", cutoff, count(*) AS days, quantile_cont(abs((actual - last_value) / nullif(actual, 0)), 0.5) AS last_value,
               quantile_cont(abs((actual - trend * coalesce(wf, 1) * coalesce(mf, 1)) / nullif(actual, 0)), 0.5) AS seasonal,
               quantile_cont(abs((actual - trend) / nullif(actual, 0)), 0.5) AS trend
        FROM r3 WHERE ds > cutoff GROUP BY ALL)"""


@query(
    "forecast_rolling",
    f"""WITH {_ROLLING} SELECT "group", cutoff, days, round(last_value, 4) AS last_value, round(seasonal, 4) AS seasonal, round(trend, 4) AS trend FROM e""",
)
def forecast_rolling(t):
    """Errors per cut-off day on the 30 days after it."""
    return fc.rolling_errors(_series(t)).withColumns({c: F.round(c, 4) for c in fc.MODELS})


@query(
    "forecast_select_unseen",
    f"""WITH {_ROLLING}, m AS (SELECT "group", count(*) AS cutoffs, avg(last_value) AS last_value, avg(seasonal) AS seasonal, avg(trend) AS trend FROM e GROUP BY 1)
        SELECT "group", CASE least(last_value, seasonal, trend) WHEN last_value THEN 'last_value' WHEN seasonal THEN 'seasonal' ELSE 'trend' END AS model,
               round(least(last_value, seasonal, trend), 4) AS mdape, cutoffs, round(last_value, 4) AS last_value, round(seasonal, 4) AS seasonal,
               round(trend, 4) AS trend FROM m""",
)
def forecast_select_unseen(t):
    best = fc.best_unseen(fc.rolling_errors(_series(t)))
    return best.withColumns({c: F.round(c, 4) for c in ("mdape", *fc.MODELS)})


# With one break the normal equations have three unknowns: solved here by Cramer's rule.
_DET = "({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"
_GRAM = {"a": "g00", "b": "g01", "c": "g02", "d": "g01", "e": "g11", "f": "g12", "g": "g02", "h": "g12", "i": "g22"}
_CRAMER = [
    _DET.format(**_GRAM),
    _DET.format(**{**_GRAM, "a": "q0", "d": "q1", "g": "q2"}),
    _DET.format(**{**_GRAM, "b": "q0", "e": "q1", "h": "q2"}),
    _DET.format(**{**_GRAM, "c": "q0", "f": "q1", "i": "q2"}),
]


@query(
    "forecast_broken_trend",
    f"""WITH s AS ({_SERIES}), b AS (SELECT "group", min(ds) AS first_ds, max(ds) AS last_ds, max(ds) - min(ds) AS span FROM s GROUP BY 1),
        days AS (SELECT "group", ds, y FROM s
                 UNION ALL SELECT "group", (last_ds + i::INTEGER)::DATE, NULL FROM b, range(1, {_DAYS + 1}) AS g(i)),
        x AS (SELECT days.*, (ds - first_ds) / span AS t, greatest((ds - first_ds) / span - 0.5::DOUBLE, 0) AS h, greatest(ds - last_ds, 0) / span AS ahead
              FROM days JOIN b USING ("group")),
        m AS (SELECT "group", count(*)::DOUBLE AS g00, sum(t) AS g01, sum(h) AS g02, sum(t * t) AS g11, sum(t * h) AS g12,
                     sum(h * h) + 0.001::DOUBLE * count(*) AS g22, sum(y) AS q0, sum(t * y) AS q1, sum(h * y) AS q2 FROM x WHERE y IS NOT NULL GROUP BY 1),
        w AS (SELECT "group", {_CRAMER[1]} / {_CRAMER[0]} AS w0, {_CRAMER[2]} / {_CRAMER[0]} AS w1, {_CRAMER[3]} / {_CRAMER[0]} AS w2 FROM m),
        f AS (SELECT x.*, w0 + w1 * t + w2 * h AS yhat, w2 FROM x JOIN w USING ("group")),
        v AS (SELECT *, var_samp(y - yhat) OVER (PARTITION BY "group") AS error FROM f)
        SELECT "group", ds, round(y, 2) AS y, round(yhat, 3) AS yhat, round(yhat + 1.96 * sqrt(error + w2 * w2 * 2 * ahead ** 3 / 3), 3) AS yhat_upper,
               round(yhat - 1.96 * sqrt(error + w2 * w2 * 2 * ahead ** 3 / 3), 3) AS yhat_lower FROM v""",
)
def forecast_broken_trend(t):
    """A trend with one bend per brand, and a band that widens with the horizon."""
    rows = fc.broken_trend(_series(t), _DAYS, breaks=1)
    return rows.withColumns({"y": F.round("y", 2), **{c: F.round(c, 3) for c in ("yhat", "yhat_upper", "yhat_lower")}})


@query(
    "forecast_report",
    f"""SELECT "group", ds, yhat, yhat_upper, yhat_lower FROM ({_FORECAST})
        WHERE "group" IN ('Brand#1', 'Brand#7') AND y IS NULL AND training_date = DATE '2024-02-01'""",
)
def forecast_report(t):
    wanted = F.col("group").isin("Brand#1", "Brand#7") & F.col("y").isNull() & (F.col("training_date") == F.lit(_RUN))
    return (
        _rounded(_forecast(t)).where(wanted).select("group", "ds", "yhat", "yhat_upper", "yhat_lower").orderBy("group", "ds")
    )


@query("forecast_store", _FORECAST)
def forecast_store(t):
    """A run 30 days ahead, then a later one 90 days ahead merged over it by day and group, month by month."""
    space = t.workspace()
    series = space.keep(_series(t), "series")
    by_month = lambda df: df.withColumn("month", F.trunc("ds", "MM"))
    sinks.write_partitioned(by_month(fc.forecast(series, 30, date(2024, 1, 1))), space.path("forecasts"), ["month"])
    later = by_month(fc.forecast(series, _DAYS, _RUN))
    merge_partitions(t.spark, space.path("forecasts"), later, ["month", "ds", "group"], "month", space.path("staging"))
    return _rounded(t.spark.read.parquet(space.path("forecasts")).drop("month"))


@query(
    "forecast_eval_store",
    f"""WITH {_FITTED}, e AS (SELECT "group", round(avg(abs(y - yhat)), 4) AS mae FROM f WHERE y IS NOT NULL GROUP BY 1)
        SELECT "group", mae, d::DATE AS training_date FROM e, (VALUES ('2024-02-01'), ('2024-03-01')) AS v(d)""",
)
def forecast_eval_store(t):
    """Metrics of two runs, appended to a table by training date."""
    name = t.workspace().table("evals")
    series = t.workspace().keep(_series(t), "series")
    for day in (_RUN, date(2024, 3, 1)):
        evals = fc.evaluate(fc.forecast(series, _DAYS, day)).select("group", "mae", "mse", "rmse", "training_date")
        sinks.save_table(evals, name, mode="append", partition_by=["training_date"])
    return t.spark.table(name).select("group", F.round("mae", 4).alias("mae"), "training_date")


def _grouped_map_totals(rows):
    inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double")
    return rows.groupBy("group").agg(
        F.count("y").alias("past"), F.count_if(F.col("y").isNull()).alias("ahead"), F.round(F.sum("y"), 2).alias("sum_y"),
        F.max("ds").alias("last_day"), (F.avg(inside) > 0.85).alias("inside"),
    )


@checked(
    "forecast_grouped_map",
    f"""WITH s AS ({_SERIES}) SELECT "group", count(*) AS past, {_DAYS}::BIGINT AS ahead, round(sum(y), 2) AS sum_y,
               max(ds) + {_DAYS} AS last_day, true AS inside FROM s GROUP BY 1""",
    _grouped_map_totals,
)
def forecast_grouped_map(t):
    """Day by day: history, fit and interval of every group."""
    return fc.forecast_grouped_map(_series(t), _DAYS, _RUN)


@query(
    "forecast_grouped_map_rows",
    f"""WITH s AS ({_SERIES}), b AS (SELECT "group", max(ds) AS last_ds FROM s GROUP BY 1),
        days AS (SELECT "group", ds, round(y, 2) AS y FROM s
                 UNION ALL SELECT "group", (last_ds + CAST(i AS INTEGER))::DATE, NULL FROM b, range(1, {_DAYS + 1}) AS g(i))
        SELECT "group", ds, y, true AS ordered FROM days""",
)
def forecast_grouped_map_rows(t):
    rows = fc.forecast_grouped_map(_series(t), _DAYS, _RUN)
    ordered = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return rows.select("group", "ds", F.round("y", 2).alias("y"), ordered.alias("ordered"))
