"""Checks of the scale rules: bounded broadcasts, hot-date splitting, event-time parsing."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorflow.functions.time import parse_event_time
from sensorflow.operators.joins import dim_join, fits_broadcast, plan_bytes
from sensorflow.sources import tables as TB


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_broadcast_only_below_the_bound(spark):
    fact = spark.range(1000).withColumn("k", F.col("id") % 10)
    dim = spark.range(10).withColumnRenamed("id", "k")  # ten longs by the plan
    assert plan_bytes(dim) == 80 and fits_broadcast(dim, 80) and not fits_broadcast(dim, 79)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no planner broadcast either
    try:
        small = dim_join(fact, dim, "k", "inner", max_bytes=80)
        large = dim_join(fact, dim, "k", "inner", max_bytes=79)
        assert "BroadcastHashJoin" in _plan(small)
        assert "BroadcastHashJoin" not in _plan(large) and "SortMergeJoin" in _plan(large)
        assert small.count() == large.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_compaction_splits_a_hot_date(spark, tmp_shared):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, f"s{i % 7}", t0 + dt.timedelta(seconds=i), float(hash(i * 7919) % 10007)) for i in range(30000)]  # all on one day
    df = spark.createDataFrame(rows, "id long, sensor_id string, timestamp timestamp_ntz, value double") \
        .withColumn("event_date", F.to_date("timestamp"))
    root = tmp_shared("hot")
    df.repartition(40).write.partitionBy("event_date").parquet(root)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        TB.compact_table(spark, root, target_bytes=100 << 10)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    sizes = [r["n"] for r in spark.read.parquet(root).groupBy(F.col("_metadata.file_path").alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 30000 and 2 <= len(sizes) < 40 and max(sizes) < 30000


EPOCH0 = dt.datetime(1970, 1, 1)


@settings(max_examples=40, deadline=None)
@given(st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2100, 1, 1)),
       st.sampled_from(["Z", "+00:00", "+02:00", "-05:30", ""]))
def test_iso_times_parse_like_python(spark, when, suffix):
    text = when.isoformat() + suffix
    expect = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    if expect.tzinfo is not None:
        expect = expect.astimezone(dt.timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(text,)], "t string").select(
        parse_event_time(F.lit(None).cast("double"), F.col("t")).alias("p")).first()
    assert row.p == expect


@settings(max_examples=40, deadline=None)
@given(st.integers(min_value=0, max_value=4_000_000_000), st.booleans())
def test_epoch_numbers_parse_like_the_validator(spark, secs, as_ms):
    n = secs * 1000 if as_ms and secs * 1000 > 2e10 else secs
    row = spark.createDataFrame([(float(n),)], "n double").select(
        parse_event_time(F.col("n"), F.lit(None).cast("string")).alias("p")).first()
    assert row.p == EPOCH0 + dt.timedelta(seconds=secs)


def test_size_verdict_runs_no_job(spark):
    sc = spark.sparkContext
    table = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")  # reads a footer
    sc.setJobGroup("size-verdict", "size-verdict")
    try:
        fits_broadcast(table.groupBy("c_nationkey").count(), 100)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert not sc.statusTracker().getJobIdsForGroup("size-verdict")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(1, 10 ** 9)), min_size=1, max_size=20))
def test_pct_is_exact_half_up(spark, pairs):
    from decimal import Decimal
    from fractions import Fraction

    from sensorflow.functions.numeric import pct

    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r.p for r in df.select(pct("n", "d").alias("p")).collect()]
    want = []
    for n, d in pairs:
        x = Fraction(100 * n, d)
        # half-up at two digits on the exact fraction
        q = (x * 100 + Fraction(1, 2)).__floor__()
        want.append(float(Decimal(q) / Decimal(100)))
    assert got == want
