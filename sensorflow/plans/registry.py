"""Named queries: each maps the test tables onto the sensor model
(``sources.testdata``) and runs one operator over the whole tables.

Double columns are rounded to 6 digits (through DECIMAL) on output so results
compare across engines whose summation order differs; operators themselves
return unrounded values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sensorflow.functions.numeric import round6
from sensorflow.functions.time import trunc_ntz
from sensorflow.operators import reports as R
from sensorflow.operators import timeseries as TS
from sensorflow.sources.testdata import TestTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[round6(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
                       for f in df.schema.fields])


def _t(spark, sf_dir) -> TestTables:
    return TestTables.shared(spark, sf_dir)


# ------------------------------------------------------------------ core reports

@register("list_sensors")
def q_list_sensors(spark, sf_dir):
    return R.list_sensors(_t(spark, sf_dir).sensors)


@register("latest_reading")
def q_latest_reading(spark, sf_dir):
    return round_doubles(TS.latest_reading(_t(spark, sf_dir).m_user))


@register("latest_readings_view")
def q_latest_readings_view(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(R.latest_readings_view(t.sensors, t.m_user))


@register("readings_per_sensor")
def q_readings_per_sensor(spark, sf_dir):
    t = _t(spark, sf_dir)
    return R.readings_per_sensor(t.sensors, t.m_user)


@register("rows_per_sensor")
def q_rows_per_sensor(spark, sf_dir):
    return R.rows_per_sensor(_t(spark, sf_dir).m_user)


@register("quality_overview")
def q_quality_overview(spark, sf_dir):
    return round_doubles(R.quality_overview(_t(spark, sf_dir).m_user))


@register("hourly_by_location")
def q_hourly_by_location(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(R.hourly_by_location(t.m_user, t.sensors, t.as_of, "7 days"))


@register("hourly_aggregates")
def q_hourly_aggregates(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(R.hourly_aggregates(t.sensors, t.m_user))


@register("daily_summary")
def q_daily_summary(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(R.daily_summary(t.sensors, t.m_user))


@register("current_vs_history")
def q_current_vs_history(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(R.current_vs_history(t.m_user, t.sensors, t.as_of, "24 hours", "7 days"))


@register("peak_values")
def q_peak_values(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(R.peak_values(t.m_user, t.sensors, t.as_of, "7 days"))


@register("completeness")
def q_completeness(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(R.completeness(t.sensors, t.m_user, t.as_of, "7 days", expected=16))


@register("out_of_range_pct")
def q_out_of_range_pct(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(R.out_of_range_pct(t.m_user, t.as_of, "7 days"))


@register("ingestion_rate")
def q_ingestion_rate(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(R.ingestion_rate(t.m_user, t.as_of, "24 hours", unit="hour"))


# ------------------------------------------------------------------ time series

@register("zscore_anomalies")
def q_zscore_anomalies(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(TS.zscore_anomalies(t.m_type, t.as_of, "30 days", k=3, limit=20))


@register("zscore_all")
def q_zscore_all(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(TS.zscore_anomalies(t.m_user, t.as_of, "30 days", k=2, limit=None))


@register("rate_of_change")
def q_rate_of_change(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(TS.rate_of_change(t.m_user, t.as_of, "7 days", min_change=0.5, limit=20))


@register("rate_of_change_all")
def q_rate_of_change_all(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(TS.rate_of_change(t.m_user, t.as_of, "30 days", min_change=0.5, limit=None,
                                           split="1 hour"))


@register("data_gaps")
def q_data_gaps(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(TS.data_gaps(t.m_user, t.as_of, "30 days", min_gap_s=12 * 3600))


@register("sensor_correlation")
def q_sensor_correlation(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(TS.sensor_correlation(t.m_type, t.as_of, "30 days", bucket="1 hour", min_n=100))


@register("sensor_correlation_exact")
def q_sensor_correlation_exact(spark, sf_dir):
    # readings at equal timestamps, as sensors on a common clock send them
    t = _t(spark, sf_dir)
    m = t.m_type.withColumn("timestamp", trunc_ntz("hour", "timestamp"))
    return round_doubles(TS.sensor_correlation(m, t.as_of, "30 days", min_n=100))


@register("moving_average")
def q_moving_average(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(TS.moving_average(t.m_type, t.as_of, "30 days", rows=7))


@register("resample")
def q_resample(spark, sf_dir):
    return round_doubles(TS.resample(_t(spark, sf_dir).m_type, "1 minute"))


@register("resample_hourly")
def q_resample_hourly(spark, sf_dir):
    return round_doubles(TS.resample(_t(spark, sf_dir).m_user, "1 hour"))


@register("feature_table")
def q_feature_table(spark, sf_dir):
    return round_doubles(TS.feature_table(_t(spark, sf_dir).m_type, "1 hour", lags=(1, 2, 3), rows=24))


# Further registrations live in their own modules.
from sensorflow.plans import queries_ingest, queries_ops  # noqa: E402,F401

__all__ = ["QUERIES", "register", "round_doubles"]
