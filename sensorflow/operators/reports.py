"""Analyst reports over ``measurements`` (m) and ``sensors`` (s).

Pattern throughout: filter (pushed to the scan) -> aggregate the fact by
sensor (map-side partial aggregation, so a hot sensor is reduced before the
shuffle) -> join the dimension to the small aggregate. Joins to the stored
dimension are broadcast behind a row-count bound; joins between two computed
aggregates are left to AQE, which broadcasts at run time when the real size
allows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow import schemas as S
from sensorflow.functions.numeric import pct, round_half_up
from sensorflow.functions.time import as_of_value, parse_interval, since, trunc_ntz, ts_lit
from sensorflow.operators.joins import dim_join


def _quality(m: DataFrame, quality: str | None) -> DataFrame:
    return m if quality is None else m.filter(F.col("quality_flag") == quality)


# ------------------------------------------------------------------ Q1 / Q21

def list_sensors(s: DataFrame) -> DataFrame:
    """All sensors ordered by id."""
    return s.orderBy("sensor_id")


def rows_per_sensor(m: DataFrame) -> DataFrame:
    """Readings per measured sensor."""
    return m.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------------------ Q3

def readings_per_sensor(s: DataFrame, m: DataFrame) -> DataFrame:
    """Count, first and last reading per sensor, silent sensors included (count 0)."""
    agg = m.groupBy("sensor_id").agg(
        F.count("id").alias("total_measurements"),
        F.min("timestamp").alias("first_reading"),
        F.max("timestamp").alias("last_reading"))
    j = s.select("sensor_id", "location").join(agg, "sensor_id", "left")
    return j.select("sensor_id", "location",
                    F.coalesce(F.col("total_measurements"), F.lit(0)).alias("total_measurements"),
                    "first_reading", "last_reading")


# ------------------------------------------------------------------ Q4

def quality_overview(m: DataFrame) -> DataFrame:
    """Share of each quality flag in percent (2 digits)."""
    agg = m.groupBy("quality_flag").agg(F.count(F.lit(1)).alias("count"))
    # The window spans the aggregated rows only (one per flag).
    total = F.sum("count").over(Window.partitionBy())
    return agg.select("quality_flag", "count", pct(F.col("count"), total).alias("percentage"))


# ------------------------------------------------------------------ Q5

def hourly_by_location(m: DataFrame, s: DataFrame, as_of: dt.datetime | None = None,
                       lookback="24 hours", quality: str | None = S.FLAG_VALID) -> DataFrame:
    """Hourly avg/min/max/count per location over the lookback.

    Readings are reduced by (sensor, hour) first, so only that reduced table
    meets the dimension, whatever either's size. NULL values count as samples
    but not in the mean.
    """
    f = _quality(since(m, as_of, lookback), quality)
    per_sensor = (f.groupBy("sensor_id", trunc_ntz("hour", "timestamp").alias("hour"))
                   .agg(F.sum("value").alias("_sum"), F.count("value").alias("_n"), F.count(F.lit(1)).alias("_rows"),
                        F.min("value").alias("_min"), F.max("value").alias("_max")))
    j = dim_join(per_sensor, s.select("sensor_id", "location"), "sensor_id", "inner")
    out = j.groupBy("location", "hour").agg(
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("avg_temp"),
        F.min("_min").alias("min_temp"), F.max("_max").alias("max_temp"),
        F.sum("_rows").alias("sample_count"))
    return out.orderBy(F.col("hour").desc(), "location")


# ------------------------------------------------------------------ Q6

def current_vs_history(m: DataFrame, s: DataFrame, as_of: dt.datetime, current="10 minutes",
                       history="24 hours", quality: str | None = S.FLAG_VALID) -> DataFrame:
    """Recent average vs. longer average per sensor, rounded to 2 digits.

    Both averages come from one pass over the longer window (conditional
    aggregation); sensors without recent readings drop out, as with the inner
    joins of the original.
    """
    as_of = as_of_value(as_of)
    cur_cut = as_of - parse_interval(current)
    his_cut = as_of - parse_interval(history)
    wide = min(cur_cut, his_cut)
    f = _quality(since(m, as_of, as_of - wide), quality)
    in_cur = F.col("timestamp") >= ts_lit(cur_cut)
    in_his = F.col("timestamp") >= ts_lit(his_cut)
    agg = (f.groupBy("sensor_id")
            .agg(F.avg(F.when(in_cur, F.col("value"))).alias("_cur"),
                 F.avg(F.when(in_his, F.col("value"))).alias("_his"))
            .filter(F.col("_cur").isNotNull() & F.col("_his").isNotNull()))
    j = dim_join(agg, s.select("sensor_id", "location"), "sensor_id", "inner")
    return j.select("sensor_id", "location",
                    round_half_up("_cur", 2).alias("current_temp"),
                    round_half_up("_his", 2).alias("day_avg"),
                    round_half_up(F.col("_cur") - F.col("_his"), 2).alias("difference"))


# ------------------------------------------------------------------ Q7

def peak_values(m: DataFrame, s: DataFrame, as_of: dt.datetime | None = None, lookback="7 days",
                quality: str | None = S.FLAG_VALID) -> DataFrame:
    """Peak, low, mean and sample standard deviation per sensor."""
    f = _quality(since(m, as_of, lookback), quality)
    agg = f.groupBy("sensor_id").agg(
        F.max("value").alias("peak_value"), F.min("value").alias("lowest_value"),
        F.avg("value").alias("mean_value"), F.stddev_samp("value").alias("std_dev"))
    j = dim_join(agg, s.select("sensor_id", "location"), "sensor_id", "inner")
    return (j.select("sensor_id", "location", "peak_value", "lowest_value", "mean_value", "std_dev")
             .orderBy(F.col("peak_value").desc(), "sensor_id"))


# ------------------------------------------------------------------ Q13 / M6

def completeness(s: DataFrame, m: DataFrame, as_of: dt.datetime | None = None, lookback="1 hour",
                 expected: int = 3600, good: float = 0.95, warning: float = 0.80) -> DataFrame:
    """Actual vs. expected readings per sensor with a Good/Warning/Poor grade.

    The grade uses the unrounded ratio; the shown percentage is rounded.
    """
    f = since(m, as_of, lookback)
    agg = f.groupBy("sensor_id").agg(F.count("id").alias("_n"))
    j = s.select("sensor_id", "location").join(agg, "sensor_id", "left")
    n = F.coalesce(F.col("_n"), F.lit(0))
    ratio = n.cast("double") / F.lit(float(expected))
    status = (F.when(ratio >= good, F.lit("Good")).when(ratio >= warning, F.lit("Warning"))
               .otherwise(F.lit("Poor")))
    return j.select("sensor_id", "location", n.alias("actual_readings"),
                    F.lit(expected).alias("expected_readings"),
                    pct(n, F.lit(expected)).alias("completeness_pct"), status.alias("status"))


# ------------------------------------------------------------------ Q14

def out_of_range_pct(m: DataFrame, as_of: dt.datetime | None = None, lookback="24 hours") -> DataFrame:
    """Share of out-of-range readings per sensor."""
    f = since(m, as_of, lookback)
    agg = f.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("quality_flag") == S.FLAG_OUT_OF_RANGE).alias("out_of_range"))
    return agg.select("sensor_id", "total", "out_of_range",
                      pct("out_of_range", "total").alias("out_of_range_pct"))


# ------------------------------------------------------------------ Q15

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def ingestion_rate(m: DataFrame, as_of: dt.datetime | None = None, lookback="10 minutes",
                   unit: str = "minute") -> DataFrame:
    """Rows landed per ``unit`` of ``created_at`` and their per-second rate.

    Every bucket is divided by the full unit length, the open first and last
    ones included. Facts written with ``by_ingest_date`` are pruned by that date.
    """
    f = since(m, as_of, lookback, col="created_at", date_col="ingest_date")
    out = f.groupBy(trunc_ntz(unit, "created_at").alias(unit)).agg(
        F.count(F.lit(1)).alias("records_inserted"))
    return (out.select(unit, "records_inserted",
                       (F.col("records_inserted") / F.lit(float(_UNIT_SECONDS[unit]))).alias("avg_per_second"))
               .orderBy(F.col(unit).desc()))


# ------------------------------------------------------------------ Q19 / Q20 / M9

def latest_readings_view(s: DataFrame, m: DataFrame) -> DataFrame:
    """Latest reading per known sensor with its dimension attributes."""
    from sensorflow.operators.timeseries import latest_reading
    latest = latest_reading(m, ordered=False)
    j = dim_join(latest, s.select("sensor_id", "location", "sensor_type", "unit"), "sensor_id", "inner")
    return (j.select("sensor_id", "location", "sensor_type", "timestamp", "value", "unit", "quality_flag")
             .orderBy("sensor_id"))


def _periodic(s: DataFrame, m: DataFrame, unit: str, label: str, quality: str | None = None) -> DataFrame:
    per = (_quality(m, quality).groupBy("sensor_id", trunc_ntz(unit, "timestamp").alias(label))
            .agg(F.avg("value").alias("avg_value"), F.min("value").alias("min_value"),
                 F.max("value").alias("max_value"), F.count(F.lit(1)).alias("sample_count"),
                 F.count_if(F.col("quality_flag") == S.FLAG_VALID).alias("_valid")))
    j = dim_join(per, s.select("sensor_id", "location"), "sensor_id", "inner")
    return j.select("sensor_id", "location", label, "avg_value", "min_value", "max_value",
                    "sample_count", pct("_valid", "sample_count").alias("valid_percentage"))


def hourly_aggregates(s: DataFrame, m: DataFrame, quality: str | None = None) -> DataFrame:
    """Per sensor and hour: avg/min/max/count and the valid share. By default
    over every flag, as the original view; ``quality='valid'`` restricts it."""
    return _periodic(s, m, "hour", "hour", quality)


def daily_summary(s: DataFrame, m: DataFrame, quality: str | None = None) -> DataFrame:
    """The hourly view's daily counterpart."""
    return _periodic(s, m, "day", "day", quality)


def register_views(s: DataFrame, m: DataFrame, prefix: str = "") -> list[str]:
    """Expose the tables and the two helper views to Spark SQL as temp views:
    ``sensors``, ``measurements``, ``latest_readings``, ``hourly_aggregates``.

    Views are lazy plans, computed on read like the database views they stand
    for; analysts can then run ``spark.sql("SELECT .. FROM hourly_aggregates")``.
    """
    views = {"sensors": s, "measurements": m, "latest_readings": latest_readings_view(s, m),
             "hourly_aggregates": hourly_aggregates(s, m)}
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]


__all__ = [
    "register_views", "list_sensors", "rows_per_sensor", "readings_per_sensor", "quality_overview",
    "hourly_by_location", "current_vs_history", "peak_values", "completeness",
    "out_of_range_pct", "ingestion_rate", "latest_readings_view", "hourly_aggregates",
    "daily_summary",
]
