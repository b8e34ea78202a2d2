"""Operators that must stay exact at any group size: quantiles, sliced feature windows, blocked correlation, distinct counts."""

import datetime as dt
import math
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorflow.operators import monitoring as MO
from sensorflow.operators import timeseries as TS
from sensorflow.operators.quantiles import exact_quantile

T0 = dt.datetime(2024, 3, 1)


def _disc(values, q):
    values = sorted(values)
    n = len(values)
    return values[max(1, n - math.floor(n - q * n)) - 1] if values else None


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_quantiles_of_large_groups_equal_duckdb(spark, q):
    rng = random.Random(4)
    rows = [(1, rng.gauss(0, 1)) for _ in range(50_000)] + [(2, math.exp(rng.uniform(-300, 300))) for _ in range(5000)]
    rows += [(3, 7.25)] * 3000 + [(3, -7.25)] * 10 + [(None, float(i % 13)) for i in range(4000)] + [(4, 1.0), (4, None), (4, 2.0), (5, None)]
    rows += [(6, v) for v in (1.7e308, -1.7e308, 0.0) for _ in range(800)] + [(7, float("nan")), (7, float("inf")), (7, 3.0)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(8)
    got = {r.k: (r.x, r.n) for r in exact_quantile(df, ["k"], "v", q, "x", [F.count(F.lit(1)).alias("n")]).collect()}
    groups = defaultdict(list)
    for k, v in rows:
        groups[k].append(v)
    want = {k: (_disc([v for v in vs if v is not None and math.isfinite(v)], q), len(vs)) for k, vs in groups.items()}
    assert got == want
    big = [v for k, v in rows if k == 1]
    assert duckdb.sql(f"SELECT quantile_disc(v, {q}) FROM (SELECT unnest({big}) AS v)").fetchall()[0][0] == got[1][0]


def test_quantile_of_two_keys_and_no_rows(spark):
    df = spark.createDataFrame([(a, b, float(i)) for a in "xy" for b in (1, None) for i in range(1500)], "a string, b int, v double")
    assert {(r.a, r.b): r.m for r in exact_quantile(df, ["a", "b"], "v", 0.5, "m").collect()} == {(a, b): 749.0 for a in "xy" for b in (1, None)}
    assert exact_quantile(df.filter("false"), ["a"], "v", 0.5, "m").collect() == []


def test_peer_median_and_lag_percentile_of_a_crowded_group(spark):
    """3,000 sensors of one location, 60,000 rows of one window: more than any sketch holds exactly."""
    rng = random.Random(9)
    rows = [(i, f"s{i % 3000}", T0 + dt.timedelta(seconds=i % 50), rng.gauss(20, 9), "valid",
             T0 + dt.timedelta(seconds=i % 50, microseconds=rng.randrange(10 ** 9))) for i in range(60_000)]
    m = spark.createDataFrame(rows, "id long, sensor_id string, timestamp timestamp_ntz, value double, quality_flag string, created_at timestamp_ntz")
    s = spark.createDataFrame([(f"s{i}", "hall") for i in range(3000)], "sensor_id string, location string")
    means = defaultdict(list)
    for r in rows:
        means[r[1]].append(r[3])
    median = _disc([math.fsum(v) / len(v) for v in means.values()], 0.5)
    got = MO.peer_consistency(m, s, "1 day", max_dev=4.0).collect()
    assert got and {round(r.peer_median, 9) for r in got} == {round(median, 9)} and {r.peers for r in got} == {3000}
    lag = MO.ingest_lag(m, "1 day").first()
    assert lag.rows == 60_000 and lag.p95_lag_seconds == _disc([(r[5] - r[2]) / dt.timedelta(microseconds=1) / 1e6 for r in rows], 0.95)


def _series(spark, seed=1):
    """One dense sensor, one sparse, one with bursts and a gap."""
    rng = random.Random(seed)
    rows = [("hot", T0 + dt.timedelta(minutes=i)) for i in range(3000)] + [("slow", T0 + dt.timedelta(hours=5 * i)) for i in range(15)]
    rows += [("burst", T0 + dt.timedelta(days=d, seconds=s)) for d in (0, 1, 9) for s in range(0, 1200, 60)]
    return spark.createDataFrame([(i, s, t, rng.gauss(10, 3), "valid") for i, (s, t) in enumerate(rows)],
                                 "id long, sensor_id string, timestamp timestamp_ntz, value double, quality_flag string")


@pytest.mark.parametrize("split, target", [("auto", 200), ("auto", 5), ("6 hours", 10 ** 6), ("7 minutes", 10 ** 6)])
def test_sliced_features_equal_plain_windows(spark, split, target):
    m = _series(spark)
    got = TS.feature_table(m, "1 minute", lags=(1, 2, 5), rows=24, split=split, target_rows=target)
    r = TS.resample(m, "1 minute", "valid")
    w = Window.partitionBy("sensor_id").orderBy("timestamp")
    roll = w.rowsBetween(-23, 0)
    want = r.select("sensor_id", "timestamp", *[F.lag("avg_value", k).over(w).alias(f"lag_{k}") for k in (1, 2, 5)],
                    F.avg("avg_value").over(roll).alias("rolling_mean"), F.stddev_samp("avg_value").over(roll).alias("rolling_std"))

    def rows(df):
        return sorted([tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in df.select(*want.columns).collect()], key=repr)
    assert rows(got) == rows(want)


def test_one_sensor_is_spread_over_slices_with_bounded_halos(spark):
    m = _series(spark).filter("sensor_id = 'hot'")
    cut = TS.with_halo(TS.resample(m, "1 minute"), 24, target_rows=100)
    per = cut.groupBy("_slice").agg(F.count(F.lit(1)).alias("n"), F.count_if("_carried").alias("halo")).collect()
    assert len(per) >= 10 and max(r.n for r in per) <= 2 * 100 + 24 and max(r.halo for r in per) == 24
    assert sum(r.n - r.halo for r in per) == 3000


def _corr_brute(rows, min_n):
    by = defaultdict(list)
    for s, t, v in rows:
        by[t].append((s, v))
    pairs = defaultdict(list)
    for at in by.values():
        for a, x in at:
            for b, y in at:
                if a < b:
                    pairs[a, b].append((x, y))
    out = {}
    for k, xy in pairs.items():
        if len(xy) > min_n:
            n, mx, my = len(xy), sum(x for x, _ in xy) / len(xy), sum(y for _, y in xy) / len(xy)
            sxy, sxx, syy = sum((x - mx) * (y - my) for x, y in xy), sum((x - mx) ** 2 for x, _ in xy), sum((y - my) ** 2 for _, y in xy)
            out[k] = (n, round(sxy / math.sqrt(sxx * syy), 6))
    return out


def _readings(spark, seed=3):
    rng = random.Random(seed)
    rows = [(f"s{k}", T0 + dt.timedelta(seconds=rng.randrange(90)), 1e6 + rng.gauss(k, 2)) for k in range(14) for _ in range(120)]
    df = spark.createDataFrame([(i, *r, "valid") for i, r in enumerate(rows)], "id long, sensor_id string, timestamp timestamp_ntz, value double, quality_flag string")
    return rows, df


@pytest.mark.parametrize("blocks, group_rows, slab", [(None, 400_000, 1024), (3, 100, 7), (20, 50, 1)])
def test_blocked_correlation_equals_the_self_join(spark, monkeypatch, blocks, group_rows, slab):
    monkeypatch.setattr(TS, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(TS, "SLAB", slab)
    rows, df = _readings(spark)
    got = {(r.sensor_1, r.sensor_2): (r.sample_size, round(r.correlation, 6)) for r in TS.sensor_correlation(df, None, "1 day", min_n=20, blocks=blocks).collect()}
    assert got == _corr_brute(rows, 20)


def test_correlation_shuffles_readings_and_not_pairs_of_time_keys(spark):
    _, df = _readings(spark)
    plan = TS.sensor_correlation(df, None, "1 day", min_n=20)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "FlatMapGroupsInArrow" in plan


def test_exact_distinct_counts(spark):
    rows = [(i % 7, float(i % 3) * (-1 if i % 2 else 1), None if i % 5 else f"v{i % 11}", i % 2 == 0, bytes([i % 4]), T0 + dt.timedelta(days=i % 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b double, c string, d boolean, e binary, f timestamp_ntz").withColumn("g", F.lit(None).cast("int"))
    got = {r.column_name: r.distinct_count for r in MO.catalog(df, "t").collect()}
    assert got == {"a": 7, "b": 5, "c": 11, "d": 2, "e": 4, "f": 9, "g": 0}
    assert {r.column_name: r.distinct_count for r in MO.catalog(df, "t", approx_distinct=True).collect()} == got
    assert {r.row_count for r in MO.catalog(df.filter("false"), "t").collect()} == {0}
