import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorflow.functions import (corr_from_moments, parse_interval, pct, pretty_size, round_half_up,
                                  topic_of, topic_regex)


def test_parse_interval():
    assert parse_interval("24 hours") == dt.timedelta(hours=24)
    assert parse_interval("10 minutes") == dt.timedelta(minutes=10)
    assert parse_interval("1 hour 30 minutes") == dt.timedelta(minutes=90)
    assert parse_interval("7 days") == dt.timedelta(days=7)
    with pytest.raises(ValueError):
        parse_interval("soon")


@pytest.mark.parametrize("pattern,topic,hit", [
    ("sensors/#", "sensors/Sensor_1", True),
    ("sensors/#", "sensors", True),          # '#' also matches the parent level
    ("sensors/#", "sensors/a/b", True),
    ("sensors/#", "other/Sensor_1", False),
    ("sensors/+", "sensors/Sensor_1", True),
    ("sensors/+", "sensors/a/b", False),
    ("sensors/+/7", "sensors/click/7", True),
    ("sensors/+/7", "sensors/click/17", False),
    ("#", "anything/at/all", True),
    ("a.b/+", "aXb/c", False),                # literal levels are escaped
])
def test_topic_regex(pattern, topic, hit):
    import re
    assert bool(re.match(topic_regex(pattern), topic)) == hit


def test_topic_of(spark):
    row = spark.createDataFrame([("Sensor 1",)], "s string").select(topic_of("s").alias("t")).first()
    assert row.t == "sensors/Sensor_1"


def test_pct_half_up_exact(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (1, 800), (2469, 20000), (0, 5), (3, 0)], "n long, d long")
    got = [r.p for r in df.select(pct("n", "d").alias("p")).collect()]
    assert got == [12.5, 33.33, 66.67, 0.13, 12.35, 0.0, None]


def test_round_half_up_on_decimal_value(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,)], "x double")
    assert [r.y for r in df.select(round_half_up("x", 2).alias("y")).collect()] == [1.01, 2.68, -1.01]


def test_corr_constant_series_is_null(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0), (3.0, 5.0)], "x double, y double")
    agg = df.agg(F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"),
                 F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("y") * F.col("y")).alias("syy"),
                 F.sum(F.col("x") * F.col("y")).alias("sxy"))
    assert agg.select(corr_from_moments("n", "sx", "sy", "sxx", "syy", "sxy").alias("c")).first().c is None


@pytest.mark.parametrize("size,text", [
    (0, "0 bytes"), (10239, "10239 bytes"), (10240, "10 kB"), (10485000, "10239 kB"), (20971519, "20 MB"),
    (20971520, "20 MB"), (1536 * 1024, "1536 kB"), (10 * 1024 ** 3, "10 GB"), (25 * 1024 ** 3, "25 GB"),
])
def test_pretty_size(spark, size, text):
    row = spark.createDataFrame([(size,)], "b long").select(pretty_size("b").alias("t")).first()
    assert row.t == text


def test_since_now_uses_the_clock_as_a_constant(spark):
    from sensorflow.functions.time import now_utc, since
    t = now_utc()
    df = spark.createDataFrame([(t - dt.timedelta(minutes=5),), (t - dt.timedelta(hours=5),)], "timestamp timestamp_ntz")
    kept = since(df, "now", "1 hour")
    assert kept.count() == 1


def test_operators_accept_now(spark):
    from sensorflow.functions.time import now_utc
    from sensorflow.operators import monitoring as MO
    from sensorflow.operators import reports as R
    from sensorflow.operators import timeseries as TS
    from sensorflow.sources import tables as TB
    t = now_utc()
    m = spark.createDataFrame([(1, "a", t - dt.timedelta(minutes=1), 1.0, "valid", t),
                               (2, "a", t - dt.timedelta(minutes=30), 3.0, "valid", t)],
                              "id long, sensor_id string, timestamp timestamp_ntz, value double, "
                              "quality_flag string, created_at timestamp_ntz")
    s = spark.createDataFrame([("a", "L", "t", "C", 0.0, 50.0, None)],
                              "sensor_id string, location string, sensor_type string, unit string, "
                              "min_value double, max_value double, created_at timestamp_ntz")
    assert R.current_vs_history(m, s, "now", "10 minutes", "1 hour").count() == 1
    assert TS.data_gaps(m, "now", "1 hour", 60, close_tail=True).count() == 2
    assert MO.health_report(s, m, "now").count() == 4
    assert MO.dq_metrics(s, m, "now", "1 day", expected=2).count() == 6
    assert TB.apply_retention(m, "now", "10 minutes").count() == 1
