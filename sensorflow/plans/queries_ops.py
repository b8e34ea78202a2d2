"""Named queries for monitoring and quality reports over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorflow.operators import monitoring as MO
from sensorflow.operators import quality as Q
from sensorflow.plans.registry import _t, register, round_doubles
from sensorflow.session import scratch_dir
from sensorflow.sources.sinks import write_raw
from sensorflow.sources.testdata import messages_from_events


@register("health_report")
def q_health_report(spark, sf_dir):
    """All six checks: the raw files of an archive and the session's tables too."""
    t = _t(spark, sf_dir)
    path = scratch_dir(spark, "raw")
    write_raw(messages_from_events(t.events), path, F.col("arrival_time"))
    tables = ["health_sensors", "health_measurements"]
    t.sensors.createOrReplaceTempView(tables[0])
    t.m_user.createOrReplaceTempView(tables[1])
    return round_doubles(MO.health_report(t.sensors, t.m_user, t.as_of, raw=spark.read.text(path), tables=tables))


@register("summary_stats")
def q_summary_stats(spark, sf_dir):
    t = _t(spark, sf_dir)
    return MO.summary_stats(t.sensors, t.m_user)


@register("dq_metrics")
def q_dq_metrics(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(MO.dq_metrics(t.sensors, t.m_user, t.as_of, period="7 days", expected=16))


@register("weekly_digest")
def q_weekly_digest(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(MO.weekly_digest(t.sensors, t.m_user, expected=16))


@register("error_rate")
def q_error_rate(spark, sf_dir):
    t = _t(spark, sf_dir)
    parsed = Q.parse_readings(messages_from_events(t.events))
    return round_doubles(MO.error_rate(parsed, "1 day", limit=0.2))


@register("ingest_lag")
def q_ingest_lag(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(MO.ingest_lag(t.m_user, "1 day", limit="5 seconds"))


@register("ingest_lag_recent")
def q_ingest_lag_recent(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(MO.ingest_lag(t.m_user, "1 hour", limit="5 seconds", as_of=t.as_of, lookback="3 days"))


@register("error_rate_recent")
def q_error_rate_recent(spark, sf_dir):
    t = _t(spark, sf_dir)
    parsed = Q.parse_readings(messages_from_events(t.events))
    return round_doubles(MO.error_rate(parsed, "1 hour", limit=0.2, as_of=t.as_of, lookback="3 days"))


@register("peer_consistency")
def q_peer_consistency(spark, sf_dir):
    t = _t(spark, sf_dir)
    return round_doubles(MO.peer_consistency(t.m_user, t.sensors, bucket="1 day", max_dev=25.0, min_peers=3))


@register("catalog")
def q_catalog(spark, sf_dir):
    return round_doubles(MO.catalog(_t(spark, sf_dir).m_user, "measurements"))
