import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorflow.operators import timeseries as TS

T0 = dt.datetime(2024, 1, 1)
MEAS = "id long, sensor_id string, timestamp timestamp_ntz, value double, quality_flag string, created_at timestamp_ntz"


def _random_series(spark, n=600, sensors=3, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = f"s{rnd.randrange(sensors)}"
        # clustered times, with equal timestamps and empty days in between
        ts = T0 + dt.timedelta(days=rnd.choice([0, 1, 3, 4, 9]), seconds=rnd.randrange(0, 4000, 7))
        rows.append((i, s, ts, round(rnd.uniform(0, 60), 2), "valid", ts))
    return spark.createDataFrame(rows, MEAS)


@pytest.mark.parametrize("split,target", [("1 day", 0), ("1 hour", 0), ("13 minutes", 0), ("auto", 5),
                                          ("auto", 10 ** 9)])
@pytest.mark.parametrize("direction", ["prev", "next"])
def test_sliced_neighbor_equals_plain_window(spark, split, target, direction):
    m = _random_series(spark)
    fn = F.lag if direction == "prev" else F.lead
    w = Window.partitionBy("sensor_id").orderBy("timestamp", "id")
    plain = m.select("id", fn("value").over(w).alias("v"), fn("timestamp").over(w).alias("t"))
    got = TS.with_neighbor(m, ["value", "timestamp"], direction, split=split, target_rows=target or 1).select(
        "id", F.col(f"{direction}_value").alias("v"), F.col(f"{direction}_timestamp").alias("t"))
    assert sorted(plain.collect()) == sorted(got.collect())


@pytest.mark.parametrize("direction", ["prev", "next"])
def test_neighbor_with_null_times_and_keys(spark, direction):
    rows = [(i, k, None if t is None else T0 + dt.timedelta(seconds=t), float(i))
            for i, (k, t) in enumerate([("a", None), ("a", 5), ("a", None), (None, 3), (None, 9), ("a", 90000), ("b", None)])]
    m = spark.createDataFrame(rows, "id long, sensor_id string, timestamp timestamp_ntz, value double")
    fn = F.lag if direction == "prev" else F.lead
    plain = m.select("id", fn("value").over(Window.partitionBy("sensor_id").orderBy("timestamp", "id")).alias("v"))
    for split in ("1 day", "1 second", "auto"):
        got = TS.with_neighbor(m, ["value"], direction, split=split, target_rows=1).select("id", F.col(f"{direction}_value").alias("v"))
        assert sorted(plain.collect()) == sorted(got.collect())


def test_bursty_sensor_is_cut_by_its_rows(spark):
    # one early reading, then all others within a few seconds a year later
    burst = T0 + dt.timedelta(days=365)
    m = spark.range(20000).select(
        F.col("id"), F.lit("a").alias("sensor_id"),
        F.when(F.col("id") == 0, F.lit(T0)).otherwise(F.timestamp_add("MICROSECOND", F.col("id") * 300, F.lit(burst)))
        .cast("timestamp_ntz").alias("timestamp"))
    sizes = [r["count"] for r in TS._auto_slices(m, "sensor_id", "timestamp", 1000).groupBy("_slice").count().collect()]
    assert sum(sizes) == 20000 and len(sizes) >= 10 and max(sizes) <= 2000


def test_neighbor_shuffles_the_fact_once_and_joins_it_to_nothing_large(spark):
    m = _random_series(spark)
    plan = TS.with_neighbor(m, ["value"], split="1 hour")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Window [") == 2  # rows of the slices, and one row per slice


def test_latest_reading_tie_breaks_on_id(spark):
    m = spark.createDataFrame([(1, "a", T0, 1.0, "valid", T0), (2, "a", T0, 2.0, "valid", T0),
                               (3, "b", T0, 3.0, "valid", T0)], MEAS)
    got = {r.sensor_id: r.value for r in TS.latest_reading(m).collect()}
    assert got == {"a": 2.0, "b": 3.0}


def test_rate_equal_timestamps_gives_null_rate(spark):
    m = spark.createDataFrame([(1, "a", T0, 1.0, "valid", T0), (2, "a", T0, 5.0, "valid", T0)], MEAS)
    r = TS.rate_of_change(m, T0, "1 hour", limit=None).collect()
    assert len(r) == 1 and r[0].change == 4.0 and r[0].seconds_elapsed == 0.0 and r[0].rate_per_second is None


def test_zscore_constant_sensor_has_no_anomalies(spark):
    rows = [(i, "a", T0 + dt.timedelta(minutes=i), 5.0, "valid", T0) for i in range(10)]
    m = spark.createDataFrame(rows, MEAS)
    assert TS.zscore_anomalies(m, T0 + dt.timedelta(hours=1), "7 days", limit=None).count() == 0


def test_zscore_scores_all_rows_against_valid_stats(spark):
    rows = [(i, "a", T0 + dt.timedelta(minutes=i), 10.0 + (i % 2), "valid", T0) for i in range(20)]
    rows.append((99, "a", T0 + dt.timedelta(minutes=30), 500.0, "out_of_range", T0))
    m = spark.createDataFrame(rows, MEAS)
    out = TS.zscore_anomalies(m, T0 + dt.timedelta(hours=1), "7 days", limit=None).collect()
    assert [r.value for r in out] == [500.0]


def test_gaps_inner_and_tail(spark):
    ts = [T0, T0 + dt.timedelta(seconds=2), T0 + dt.timedelta(seconds=30)]
    m = spark.createDataFrame([(i, "a", t, 1.0, "valid", t) for i, t in enumerate(ts)], MEAS)
    as_of = T0 + dt.timedelta(seconds=100)
    inner = TS.data_gaps(m, as_of, "1 hour", 5).collect()
    assert [(r.gap_start, r.gap_seconds) for r in inner] == [(ts[1], 28.0)]
    tail = TS.data_gaps(m, as_of, "1 hour", 5, close_tail=True).collect()
    assert sorted(r.gap_seconds for r in tail) == [28.0, 70.0]


def test_moving_average_rows_vs_range_on_missing_day(spark):
    days = [0, 1, 3]  # day 2 missing
    m = spark.createDataFrame([(d, "a", T0 + dt.timedelta(days=d), float(d), "valid", T0) for d in days], MEAS)
    as_of = T0 + dt.timedelta(days=4)
    rows = {r.day.day: r.moving_avg_7day for r in TS.moving_average(m, as_of, "30 days", rows=2).collect()}
    rng = {r.day.day: r.moving_avg_7day for r in TS.moving_average(m, as_of, "30 days", rows=2, frame="range").collect()}
    assert rows[4] == 2.0  # rows frame: day 3 and the previous non-empty day (day 1)
    assert rng[4] == 3.0   # range frame: days 3..2 only


def test_correlation_exact_time_matches_brute_force(spark):
    rnd = random.Random(3)
    rows, i = [], 0
    for k in range(150):
        ts = T0 + dt.timedelta(seconds=k)
        for s in ("a", "b", "c"):
            for _ in range(1 + (k % 3 == 0 and s == "a")):  # duplicates of (a, ts)
                rows.append((i, s, ts, rnd.uniform(0, 10), "valid", ts))
                i += 1
    m = spark.createDataFrame(rows, MEAS)
    got = {(r.sensor_1, r.sensor_2): (r.correlation, r.sample_size)
           for r in TS.sensor_correlation(m, T0 + dt.timedelta(hours=1), "1 day", min_n=100).collect()}
    a, b = m.alias("a"), m.alias("b")
    brute = (a.join(b, (F.col("a.timestamp") == F.col("b.timestamp")) & (F.col("a.sensor_id") < F.col("b.sensor_id")))
              .groupBy(F.col("a.sensor_id").alias("s1"), F.col("b.sensor_id").alias("s2"))
              .agg(F.corr("a.value", "b.value").alias("c"), F.count("*").alias("n")).collect())
    assert len(brute) == len(got) == 3
    for r in brute:
        c, n = got[(r.s1, r.s2)]
        assert n == r.n and abs(c - r.c) < 1e-9


def test_correlation_blocks_and_peers(spark):
    rnd = random.Random(5)
    rows = [(k * 9 + j, f"s{j}", T0 + dt.timedelta(hours=k), rnd.random(), "valid", T0) for k in range(110) for j in range(9)]
    m = spark.createDataFrame(rows, MEAS)

    def corr(**kw):
        out = TS.sensor_correlation(m, T0 + dt.timedelta(days=10), "30 days", min_n=100, **kw).collect()
        return {(r.sensor_1, r.sensor_2): (round(r.correlation, 9), r.sample_size) for r in out}
    every = corr(blocks=1)
    assert len(every) == 36 and corr(blocks=3) == every
    groups = spark.createDataFrame([(f"s{j}", "x" if j < 3 else "y") for j in range(8)], "sensor_id string, peer_group string")
    got = corr(peers=groups)
    assert len(got) == 3 + 10 and got.items() <= every.items()


def test_correlation_constant_side_is_null(spark):
    rows = [(k * 2 + j, s, T0 + dt.timedelta(hours=k), v, "valid", T0)
            for k in range(120) for j, (s, v) in enumerate([("a", 1.0), ("b", float(k % 7))])]
    m = spark.createDataFrame(rows, MEAS)
    out = TS.sensor_correlation(m, T0 + dt.timedelta(days=10), "30 days", bucket="1 hour", min_n=100).collect()
    assert len(out) == 1 and out[0].correlation is None and out[0].sample_size == 120


def test_resample_shape(spark):
    m = _random_series(spark, n=100)
    r = TS.resample(m, "1 minute")
    assert r.columns == ["sensor_id", "timestamp", "avg_value", "min_value", "max_value", "sample_count"]
    assert r.agg(F.sum("sample_count")).first()[0] == 100
    assert dict(r.dtypes)["timestamp"] == "timestamp_ntz"
