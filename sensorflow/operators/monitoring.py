"""Monitoring and data-quality products: health checks, summaries, error rate,
lag, per-sensor quality metrics, digests, peer consistency, column catalogue,
per-batch alerts.

Every report is one aggregate pass per input table, reshaped to long form with
``stack``; multi-row outputs are unions of those one-row aggregates, never
joins of them.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow import schemas as S
from sensorflow.functions.numeric import pct
from sensorflow.functions.time import as_of_value, epoch_seconds_between, parse_interval, since, trunc_ntz, ts_lit
from sensorflow.operators.joins import dim_join
from sensorflow.operators.quantiles import exact_quantile
from sensorflow.session import materialize

# Health thresholds of the end-to-end check.
HEALTH_THRESHOLDS = {
    "sensors": 5,            # at least this many sensors in the dimension
    "measurements": 40,      # at least this many readings
    "freshness_seconds": 10,  # newest reading at most this old
    "active_sensors": 5,     # sensors reporting in the active window
    "active_window": "30 seconds",
    "raw_files": 1,          # at least one raw archive file
}

# Proposed alert limits.
ERROR_RATE_LIMIT = 0.01
LAG_LIMIT = "5 minutes"


def _stack(one_row: DataFrame, items: list[tuple[str, str, float, str, str]]) -> DataFrame:
    """(check_name, value expr, threshold, comparison, level-if-failed) -> long rows."""
    n = len(items)
    args = ", ".join(
        f"'{name}', CAST({expr} AS DOUBLE), CAST({thr} AS DOUBLE), '{cmp}', '{lvl}'"
        for name, expr, thr, cmp, lvl in items)
    long = one_row.selectExpr(f"stack({n}, {args}) AS (check_name, value, threshold, comparison, fail_level)")
    ok = F.when(F.col("comparison") == ">=", F.col("value") >= F.col("threshold")).otherwise(
        F.col("value") <= F.col("threshold"))
    return long.select("check_name", "value", "threshold", "comparison",
                       F.when(F.coalesce(ok, F.lit(False)), F.lit("PASS")).otherwise(F.col("fail_level"))
                       .alias("status"))


# ------------------------------------------------------------------ P12

def tables_present(spark, names) -> DataFrame:
    """Which of the expected tables the session catalogue knows (name, present)."""
    names = list(names)
    known = {t.name for t in spark.catalog.listTables()}
    rows = [(n, n in known or spark.catalog.tableExists(n)) for n in names]
    return spark.createDataFrame(rows, "table_name string, present boolean")


# ------------------------------------------------------------------ M1

def health_report(s: DataFrame, m: DataFrame, as_of: dt.datetime, raw: DataFrame | None = None,
                  thresholds: dict | None = None, tables=None) -> DataFrame:
    """End-to-end health checks as rows (check_name, value, threshold, comparison, status).

    ``tables`` (names) adds a check that all of them exist in the catalogue.
    """
    th = dict(HEALTH_THRESHOLDS, **(thresholds or {}))
    as_of = as_of_value(as_of)
    cut = as_of - parse_interval(th["active_window"])
    sa = s.agg(F.count(F.lit(1)).alias("n_sensors"))
    ma = m.agg(F.count(F.lit(1)).alias("n_rows"),
               epoch_seconds_between(F.max("timestamp"), ts_lit(as_of)).alias("fresh"),
               F.count_distinct(F.when(F.col("timestamp") >= ts_lit(cut), F.col("sensor_id"))).alias("active"))
    parts = [
        _stack(sa, [("sensors", "n_sensors", th["sensors"], ">=", "FAIL")]),
        _stack(ma, [("measurements", "n_rows", th["measurements"], ">=", "FAIL"),
                    ("freshness_seconds", "fresh", th["freshness_seconds"], "<=", "FAIL"),
                    ("active_sensors", "active", th["active_sensors"], ">=", "WARNING")]),
    ]
    if raw is not None:
        ra = raw.agg(F.count_distinct(F.col("_metadata.file_path")).alias("files"))
        parts.append(_stack(ra, [("raw_files", "files", th["raw_files"], ">=", "WARNING")]))
    if tables:
        names = list(tables)
        tp = tables_present(s.sparkSession, names).agg(F.count_if("present").alias("present"))
        parts.insert(0, _stack(tp, [("tables", "present", len(names), ">=", "FAIL")]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ M4

def summary_stats(s: DataFrame, m: DataFrame) -> DataFrame:
    """Sensors, measurements and the latest reading time (HH:mm:ss) as text rows."""
    a = s.agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit("Sensors").alias("metric"), "value")
    b = m.agg(F.count(F.lit(1)).cast("string").alias("n"),
              F.date_format(F.max("timestamp"), "HH:mm:ss").alias("t"))
    b = b.selectExpr("stack(2, 'Measurements', n, 'Latest Reading', t) AS (metric, value)")
    return a.unionByName(b)


# ------------------------------------------------------------------ M2

def error_rate(parsed: DataFrame, window: str = "1 hour", time_col: str = "arrival_time",
               limit: float = ERROR_RATE_LIMIT, as_of: dt.datetime | None = None, lookback=None) -> DataFrame:
    """Share of rejected messages per time window, with an alert flag.

    ``lookback`` keeps messages of that long before ``as_of`` (all by default); an
    archive partitioned by ``ingest_date`` is pruned by it.
    """
    parsed = since(parsed, as_of, lookback, col=time_col, date_col="ingest_date")
    g = parsed.groupBy(F.window(time_col, window).start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("error_class").isNotNull()).alias("errors"))
    rate = F.try_divide(F.col("errors").cast("double"), F.col("messages").cast("double"))
    return g.select("window_start", "messages", "errors", rate.alias("error_rate"),
                    (rate > F.lit(limit)).alias("alert"))


# ------------------------------------------------------------------ M3

def ingest_lag(m: DataFrame, window: str = "1 hour", limit=LAG_LIMIT, as_of: dt.datetime | None = None,
               lookback=None) -> DataFrame:
    """Landing lag (created_at - timestamp) per window of landing time, over
    ``lookback`` before ``as_of`` (all rows by default).

    The 95th percentile is exact however many rows a window has, without
    gathering them (``quantiles.exact_quantile``).
    """
    m = since(m, as_of, lookback, col="created_at", date_col="ingest_date")
    lim = parse_interval(limit).total_seconds()
    lags = m.select(F.window("created_at", window).start.alias("window_start"),
                    epoch_seconds_between("timestamp", "created_at").alias("_lag"))
    g = exact_quantile(lags, ["window_start"], "_lag", 0.95, "p95_lag_seconds", [
        F.count(F.lit(1)).alias("rows"), F.avg("_lag").alias("avg_lag_seconds"), F.max("_lag").alias("max_lag_seconds")])
    return g.select("window_start", "rows", "avg_lag_seconds", "max_lag_seconds", "p95_lag_seconds",
                    (F.col("max_lag_seconds") > F.lit(lim)).alias("alert"))


# ------------------------------------------------------------------ M5 / M10

def dq_metrics(s: DataFrame, m: DataFrame, as_of: dt.datetime, period="1 day",
               expected: int = 86400) -> DataFrame:
    """Per-sensor quality indicators over ``period`` in the long ``data_quality`` shape:
    (sensor_id, check_timestamp, metric_name, metric_value, status).

    completeness_pct (vs. ``expected`` readings), valid_pct, out_of_range_pct,
    freshness_seconds (NULL for silent sensors), duplicate_readings (readings
    sharing a sensor and timestamp with an earlier one) and gap_hours (hours
    back from ``as_of`` within the period that hold no reading).
    """
    as_of = as_of_value(as_of)
    f = since(m, as_of, period)
    hours = math.ceil(parse_interval(period).total_seconds() / 3600)
    hour = F.floor(F.timestamp_diff("SECOND", "timestamp", ts_lit(as_of)) / 3600)
    hour = F.when(hour.between(0, hours - 1), hour)
    per_ts = f.groupBy("sensor_id", "timestamp").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality_flag") == S.FLAG_VALID).alias("v"),
        F.count_if(F.col("quality_flag") == S.FLAG_OUT_OF_RANGE).alias("o"))
    agg = per_ts.groupBy("sensor_id").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("o").alias("o"),
        F.max("timestamp").alias("last"), F.sum(F.col("n") - 1).alias("dups"),
        F.count_distinct(hour).alias("hours"))
    j = s.select("sensor_id").join(agg, "sensor_id", "left").select(
        "sensor_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"),
        F.coalesce("o", F.lit(0)).alias("o"), "last", F.coalesce("dups", F.lit(0)).alias("dups"), F.coalesce("hours", F.lit(0)).alias("hours"))
    j = j.select("sensor_id",
                 pct("n", F.lit(expected)).alias("completeness_pct"),
                 pct("v", "n").alias("valid_pct"),
                 pct("o", "n").alias("out_of_range_pct"),
                 epoch_seconds_between("last", ts_lit(as_of)).alias("freshness_seconds"),
                 F.col("dups").cast("double").alias("duplicate_readings"),
                 (F.lit(hours) - F.col("hours")).cast("double").alias("gap_hours"))
    long = j.selectExpr(
        "sensor_id",
        "stack(6, 'completeness_pct', completeness_pct, 'valid_pct', valid_pct, "
        "'out_of_range_pct', out_of_range_pct, 'freshness_seconds', freshness_seconds, "
        "'duplicate_readings', duplicate_readings, 'gap_hours', gap_hours) AS (metric_name, metric_value)")
    v = F.col("metric_value")
    name = F.col("metric_name")
    status = (F.when(v.isNull(), F.lit("FAIL"))
               .when(name == "completeness_pct", F.when(v >= 95, "OK").when(v >= 80, "WARNING").otherwise("FAIL"))
               .when(name == "valid_pct", F.when(v >= 99, "OK").when(v >= 95, "WARNING").otherwise("FAIL"))
               .when(name == "out_of_range_pct", F.when(v <= 1, "OK").when(v <= 5, "WARNING").otherwise("FAIL"))
               .when(name == "freshness_seconds",
                     F.when(v <= 10, "OK").when(v <= parse_interval(LAG_LIMIT).total_seconds(), "WARNING")
                     .otherwise("FAIL"))
               .otherwise(F.when(v == 0, "OK").otherwise("WARNING")))
    return long.select("sensor_id", ts_lit(as_of).alias("check_timestamp"), "metric_name", "metric_value",
                       status.alias("status"))


def weekly_digest(s: DataFrame, m: DataFrame, expected: int = 604800) -> DataFrame:
    """The indicators of ``dq_metrics`` by week (from Monday), over all sensors that report in it.

    sensors_reporting, readings, flag shares, completeness_pct (against
    ``expected`` readings a sensor and week), duplicate_readings (readings sharing
    a sensor and timestamp with an earlier one), gap_hours (hours of the week
    without a reading, summed over sensors) and missing_sensors (known sensors
    without a reading in the week). Sensors are reduced step by step (time, hour, week), so no distinct
    set of times or sensors is held in one task.
    """
    per_ts = m.groupBy("sensor_id", "timestamp").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality_flag") == S.FLAG_VALID).alias("v"),
        F.count_if(F.col("quality_flag") == S.FLAG_OUT_OF_RANGE).alias("o"),
        F.count_if(F.col("quality_flag") == S.FLAG_UNKNOWN).alias("u"))
    per_hour = per_ts.groupBy("sensor_id", trunc_ntz("hour", "timestamp").alias("hour")).agg(
        *[F.sum(c).alias(c) for c in "nvou"], F.sum(F.col("n") - 1).alias("dups"))
    per_week = per_hour.groupBy("sensor_id", trunc_ntz("week", "hour").alias("week")).agg(
        *[F.sum(c).alias(c) for c in [*"nvou", "dups"]], F.count(F.lit(1)).alias("hours"))
    known = s.select("sensor_id").distinct().withColumn("known", F.lit(1))
    g = per_week.join(known, "sensor_id", "left").groupBy("week").agg(
        F.count(F.lit(1)).alias("sensors_reporting"), F.sum("n").alias("readings"),
        *[F.sum(c).alias(c) for c in [*"vou", "dups", "hours"]], F.count("known").alias("known"))
    total = s.select("sensor_id").distinct().agg(F.count(F.lit(1)).alias("total"))  # one row
    return g.join(F.broadcast(total)).select(
        "week", "sensors_reporting", "readings", pct("v", "readings").alias("valid_pct"),
        pct("o", "readings").alias("out_of_range_pct"), pct("u", "readings").alias("unknown_sensor_pct"),
        pct("readings", F.col("sensors_reporting") * expected).alias("completeness_pct"),
        F.col("dups").alias("duplicate_readings"),
        (F.col("sensors_reporting") * 168 - F.col("hours")).alias("gap_hours"),
        (F.col("total") - F.col("known")).alias("missing_sensors"))


# ------------------------------------------------------------------ M8

def peer_consistency(m: DataFrame, s: DataFrame, bucket: str = "1 hour", max_dev: float = 50.0,
                     min_peers: int = 3, quality: str | None = S.FLAG_VALID) -> DataFrame:
    """Sensors whose bucket mean departs from the median of their location's
    sensors by more than ``max_dev``.

    Readings are reduced to one mean per (sensor, bucket), kept in the shared
    folder. The peer median is the lower median, exact however many sensors
    share a location, without gathering them (``quantiles.exact_quantile``).
    """
    f = m if quality is None else m.filter(F.col("quality_flag") == quality)
    per = f.groupBy("sensor_id", F.window("timestamp", bucket).start.alias("bucket")).agg(
        F.avg("value").alias("sensor_mean"))
    per = materialize(dim_join(per, s.select("sensor_id", "location"), "sensor_id", "inner"))
    peers = exact_quantile(per, ["location", "bucket"], "sensor_mean", 0.5, "peer_median", [F.count(F.lit(1)).alias("peers")])
    j = per.join(peers.filter(F.col("peers") >= min_peers), ["location", "bucket"], "inner")
    dev = F.col("sensor_mean") - F.col("peer_median")
    return (j.filter(F.abs(dev) > F.lit(max_dev))
             .select("sensor_id", "location", "bucket", "sensor_mean", "peer_median", "peers",
                     dev.alias("deviation")))


# ------------------------------------------------------------------ M11

def catalog(df: DataFrame, name: str, approx_distinct: bool = False) -> DataFrame:
    """Column catalogue of a table: type, rows, nulls, distinct values, min, max.

    Nulls and bounds are one aggregate pass. Distinct values are exact: a second
    pass turns each row into its (column, value) pairs, which are reduced per
    task before they are shuffled, by value, so no column's values meet in one
    task; what is left is counted per column. Values are told apart by their
    text, so NaN is one value and -0.0 is 0.0. ``approx_distinct`` takes
    HyperLogLog++ sketches in the first pass instead.
    """
    cols = [f for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(cols):
        c = F.col(f.name)
        aggs += [F.count_if(c.isNull()).alias(f"_z{i}"), F.min(c).cast("string").alias(f"_lo{i}"), F.max(c).cast("string").alias(f"_hi{i}")]
        if approx_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"_d{i}"))
    one = df.agg(*aggs)
    items = ", ".join(f"{i}, '{f.name}', '{f.dataType.simpleString()}', _z{i}, _lo{i}, _hi{i}" + (f", _d{i}" if approx_distinct else "")
                      for i, f in enumerate(cols))
    long = one.selectExpr("_rows", f"stack({len(cols)}, {items}) AS (_i, column_name, data_type, null_count, min_value, max_value"
                          + (", distinct_count)" if approx_distinct else ")"))
    if not approx_distinct:
        def text(f: T.StructField) -> Column:
            c = F.col(f.name)
            if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
                c = F.when(c == 0, F.lit(0.0)).otherwise(c)  # -0.0 equals 0.0
            return (F.hex(c) if isinstance(f.dataType, T.BinaryType) else c.cast("string")).alias("v")
        pairs = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), text(f)) for i, f in enumerate(cols)])))
        counts = pairs.filter("v IS NOT NULL").groupBy("_i", "v").agg(F.lit(1).alias("_one")).groupBy("_i").agg(F.count(F.lit(1)).alias("distinct_count"))
        long = long.join(counts, "_i", "left")  # a row per column on both sides
    return long.select(F.lit(name).alias("table_name"), "column_name", "data_type",
                       F.col("_rows").alias("row_count"), "null_count",
                       pct("null_count", "_rows").alias("null_pct"),
                       F.coalesce("distinct_count", F.lit(0)).cast("long").alias("distinct_count"), "min_value", "max_value")


# ------------------------------------------------------------------ T7

def batch_alerts(parsed: DataFrame, batch_id: int, error_limit: float = ERROR_RATE_LIMIT,
                 lag_limit=LAG_LIMIT) -> DataFrame:
    """One row per micro-batch from its parsed messages: error rate and landing
    lag (created_at - timestamp of valid readings) against the alert limits."""
    lim = parse_interval(lag_limit).total_seconds()
    one = parsed.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("error_class").isNotNull()).alias("rejected"),
        F.max(epoch_seconds_between("timestamp", "created_at")).alias("max_lag_seconds"))
    rate = F.try_divide(F.col("rejected").cast("double"), F.col("messages").cast("double"))
    return one.select(F.lit(batch_id).cast("long").alias("batch_id"), "messages", "rejected",
                      rate.alias("error_rate"), "max_lag_seconds",
                      F.coalesce(rate > F.lit(error_limit), F.lit(False)).alias("error_alert"),
                      F.coalesce(F.col("max_lag_seconds") > F.lit(lim), F.lit(False)).alias("lag_alert"))


__all__ = ["tables_present", "health_report", "summary_stats", "error_rate", "ingest_lag", "dq_metrics", "weekly_digest",
           "peer_consistency", "catalog", "batch_alerts", "HEALTH_THRESHOLDS"]
