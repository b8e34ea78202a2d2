import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sensorflow.functions.text import pretty_size
from sensorflow.session import local_path
from sensorflow.sources import files as FL
from sensorflow.sources import sinks as SK
from sensorflow.sources import tables as TB
from sensorflow.sources.messages import read_messages, filter_topic

T0 = dt.datetime(2024, 3, 1)
MEAS = "id long, sensor_id string, timestamp timestamp_ntz, value double, quality_flag string, created_at timestamp_ntz"


def _m(spark, days):
    return spark.createDataFrame(
        [(i, "a", T0 - dt.timedelta(days=d, seconds=s), 1.0, "valid", T0) for i, (d, s) in enumerate(days)], MEAS)


def _files(path):
    root = Path(local_path(path))
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in root.rglob("*.parquet")}


@pytest.mark.parametrize("batches", [None, (1, 2)])
def test_retention_boundary_is_strict_and_other_files_stay(spark, tmp_shared, batches):
    # 90 days exactly is kept (the delete is strictly older than the cut)
    as_of = T0 + dt.timedelta(hours=12)
    rows = [(0, 0), (1, 0), (90, -12 * 3600), (90, 0), (90, -12 * 3600 + 1), (90, -13 * 3600), (91, 0), (200, 0)]
    m = _m(spark, rows)
    root = tmp_shared("ret")
    if batches is None:
        SK.write_measurements(m, root)
    else:  # batch 2 holds expired rows of the boundary date only, batch 1 expired and kept ones
        SK.write_measurements(m.filter("id <> 3"), root, 1)
        SK.write_measurements(m.filter("id = 3"), root, 2)
    before = _files(root)
    TB.drop_expired(spark, root, as_of, "90 days")
    assert sorted(r.id for r in spark.read.parquet(root).collect()) == [0, 1, 2, 5]
    assert sorted(r.id for r in TB.expired_rows(m, as_of, "90 days").collect()) == [3, 4, 6, 7]
    after = _files(root)
    young = {f: t for f, t in before.items() if "=2024-" in f}
    assert young and young.items() <= after.items()
    assert TB.drop_expired(spark, root, as_of, "90 days") == 0 and _files(root) == after


def test_compaction_folds_small_files_of_their_dates_only(spark, tmp_shared):
    m = _m(spark, [(d, s) for d in range(3) for s in range(40)])
    root = tmp_shared("comp")
    SK.write_measurements(m.filter(F.to_date("timestamp") == F.lit(T0.date())), root)
    loose = m.filter(F.to_date("timestamp") != F.lit(T0.date())).withColumn("event_date", F.to_date("timestamp"))
    loose.repartition(6).write.mode("append").partitionBy("event_date").parquet(root)
    before = _files(root)
    dates = TB.compact_table(spark, root)
    after = _files(root)
    one = {f: t for f, t in before.items() if f"={T0.date()}" in f}
    assert one.items() <= after.items() and str(T0.date()) not in dates
    assert len(before) > len(after) == len({f.split("/")[0] for f in after})
    assert sorted(r.id for r in spark.read.parquet(root).collect()) == list(range(120))
    assert TB.compact_table(spark, root) == [] and _files(root) == after


def _batches(spark, root, batches=6):
    """Six batches of one row each for one date, and one batch of the next date."""
    for b in range(batches):
        SK.write_measurements(_m(spark, [(0, -b - 1)]).withColumn("id", F.lit(b).cast("long")), root, b)
    SK.write_measurements(_m(spark, [(-1, -5)]).withColumn("id", F.lit(100).cast("long")), root, batches)


def test_compaction_folds_the_batches_of_a_closed_date(spark, tmp_shared):
    root = tmp_shared("comp")
    _batches(spark, root)
    before = spark.read.parquet(root).select("id", "sensor_id", "timestamp", "value").collect()
    assert len(_files(root)) == 7
    assert TB.compact_table(spark, root, before_date=T0.date() + dt.timedelta(days=1)) == [str(T0.date())]
    assert len(_files(root)) == 2
    back = spark.read.parquet(root)
    assert sorted(before) == sorted(back.select("id", "sensor_id", "timestamp", "value").collect())
    assert {(r.event_date, r.batch_id) for r in back.collect()} == {(T0.date(), TB.COMPACTED), (T0.date() + dt.timedelta(days=1), 6)}
    SK.write_measurements(_m(spark, [(0, -50)]).withColumn("id", F.lit(200).cast("long")), root, 7)  # a late batch
    assert TB.compact_table(spark, root) == [str(T0.date())]
    assert spark.read.parquet(root).filter(F.col("event_date") == F.lit(T0.date())).count() == 7 and len(_files(root)) == 2


@pytest.mark.parametrize("lost_at", ["write", "move", "delete"])
def test_a_lost_driver_leaves_the_table_whole(spark, tmp_shared, monkeypatch, lost_at):
    """The driver is lost while new files are written, before they are moved, or before old ones are deleted."""
    root = tmp_shared("lost")
    _batches(spark, root)
    want = sorted(spark.read.parquet(root).select("id", "value").collect())

    def lost(*args):
        raise KeyboardInterrupt
    with monkeypatch.context() as mp:
        if lost_at == "write":
            mp.setattr(type(spark.range(1)), "hint", lost)
        elif lost_at == "move":
            mp.setattr(FL, "_finish", lost)
        else:
            finish = FL._finish

            def half(spark, root, run):
                mp.setattr(type(spark.read), "text", lost)  # moved, not yet deleted
                finish(spark, root, run)
            mp.setattr(FL, "_finish", half)
        with pytest.raises(KeyboardInterrupt):
            TB.compact_table(spark, root)
    if lost_at != "delete":
        assert sorted(spark.read.parquet(root).select("id", "value").collect()) == want
    TB.compact_table(spark, root)
    assert sorted(spark.read.parquet(root).select("id", "value").collect()) == want and len(_files(root)) == 2
    assert not FL.exists(spark, f"{root}/{FL.REWRITES}") or not os.listdir(f"{root}/{FL.REWRITES}".replace("file:", ""))


def test_table_stats(spark, tmp_shared):
    p = tmp_shared("stats")
    _m(spark, [(d, s) for d in range(3) for s in range(10)]).withColumn("event_date", F.to_date("timestamp")) \
        .repartition(3).write.partitionBy("event_date").parquet(p)
    size = sum(f.stat().st_size for f in Path(local_path(p)).rglob("*.parquet"))
    r = TB.table_stats(spark, p, "measurements").first()
    assert r.row_count == 30 and r.indexes_size is None
    assert r.total_size == spark.range(1).select(pretty_size(F.lit(size))).first()[0]
    by = {r.event_date: (r.row_count, r.total_size) for r in TB.table_stats(spark, p, "measurements", by="event_date").collect()}
    for d, (n, text) in by.items():
        part = sum(f.stat().st_size for f in Path(local_path(p)).rglob("*.parquet") if f"={d}/" in str(f))
        assert text == spark.range(1).select(pretty_size(F.lit(part))).first()[0]
    assert sum(n for n, _ in by.values()) == 30 and len(by) >= 3
    plan = TB.table_stats(spark, p, "measurements")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_raw_archive_round_trip_keeps_bodies(spark, tmp_shared):
    bodies = ['{"sensor_id":"a","timestamp":1704103200,"value":NaN,"unit":"C"}',
              '{"sensor_id":"a","timestamp":1704103200,"value":2.5,"unit":"C"}',
              '{"sensor_id":"a",', "null", '[1, 2]']
    msgs = spark.createDataFrame([(f"sensors/{i}", b, T0) for i, b in enumerate(bodies)],
                                 "topic string, body string, arrival_time timestamp_ntz")
    path = tmp_shared("raw")
    SK.write_raw(msgs, path, F.col("arrival_time"))
    back = read_messages(spark, path)
    got = sorted((r.topic, r.body, r.arrival_time) for r in back.collect())
    assert got == sorted((f"sensors/{i}", b, T0) for i, b in enumerate(bodies))  # verbatim, JSON or not
    assert filter_topic(back, "sensors/#").count() == len(bodies)
    assert {r.ingest_date for r in spark.read.text(path).select(F.col("ingest_date").cast("string")).collect()} \
        == {"20240301"}


def test_export_csv_round_trip(spark, tmp_shared):
    m = _m(spark, [(0, 5), (0, 3), (0, 4000)])
    s = spark.createDataFrame([("a", "L", "t", "C", 0.0, 50.0)],
                              "sensor_id string, location string, sensor_type string, unit string, "
                              "min_value double, max_value double")
    p = tmp_shared("csv")
    SK.export_csv(m, s, p, T0, "1 hour", single_file=True)
    back = spark.read.option("header", True).csv(p)
    assert back.columns == SK.EXPORT_COLUMNS
    ts = [r.timestamp for r in back.collect()]
    assert len(ts) == 2 and ts == sorted(ts)


def test_read_sensors_and_reference_shaped_catalog(spark, tmp_shared):
    from sensorflow.sources.sensors import read_sensor_catalog, read_sensors
    p = tmp_shared("sensors")
    spark.createDataFrame([("Sensor 1", "Room A", "temperature", "C", 0.0, 50.0, 1)],
                          "sensor_id string, location string, sensor_type string, unit string, min_value double, "
                          "max_value double, extra int").write.parquet(p)
    s = read_sensors(spark, p)
    assert s.columns == ["sensor_id", "location", "sensor_type", "unit", "min_value", "max_value"]
    # a pretty-printed catalogue document, in the producer's shape
    doc = """{
  "sensors": [
    {"id": "hum-7", "location": {"lat": 47.5, "lng": 8.25}, "type": "humidity", "unit": "%",
     "range": {"min": 5, "max": 95}, "description": "Cold store, east wall"},
    {"id": "hum-8", "location": {"lat": -33, "lng": 151}, "type": "humidity", "unit": "%",
     "range": {"min": 12, "max": 88}, "description": "Loading dock"}
  ]
}"""
    c = tmp_shared("catalog")
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.text(c)
    rows = {r.sensor_id: r for r in read_sensor_catalog(spark, c).collect()}
    assert set(rows) == {"hum-7", "hum-8"}
    assert rows["hum-8"].min_value == 12.0 and rows["hum-8"].max_value == 88.0
    assert rows["hum-8"].lat == -33.0 and rows["hum-8"].description == "Loading dock"
    assert rows["hum-7"].location == '{"lat":47.5,"lng":8.25}'


def test_with_defaults_and_rollup_sink(spark, tmp_shared):
    from sensorflow.operators.quality import with_defaults
    from sensorflow.operators.timeseries import resample
    m = spark.createDataFrame([(1, "a", T0, 1.0, None, None), (2, "a", T0, 2.0, "out_of_range", T0)], MEAS)
    now = F.lit(dt.datetime(2024, 5, 5)).cast("timestamp_ntz")
    got = {r.id: (r.quality_flag, r.created_at) for r in with_defaults(m, now).collect()}
    assert got == {1: ("valid", dt.datetime(2024, 5, 5)), 2: ("out_of_range", T0)}
    p = tmp_shared("rollup")
    SK.write_rollup(resample(m, "1 minute"), p)
    back = spark.read.parquet(p)
    assert back.count() == 1 and "event_date" in back.columns
    assert back.first().sample_count == 2


def test_fact_layout_prunes_by_date_and_sensor(spark, tmp_shared):
    from sensorflow.functions.time import since
    m = _m(spark, [(d, s) for d in range(3) for s in range(5)])
    p = tmp_shared("fact")
    SK.write_measurements(m, p, batch_id=1, by_sensor=True)
    back = spark.read.parquet(p)
    assert set(back.columns) >= {"event_date", "sensor_id", "batch_id"}
    f = since(back, T0, "1 day").filter(F.col("sensor_id") == "a")
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan
    assert f.count() == 5 + 1  # day 0 and the boundary reading exactly one day before


def test_operational_lookbacks_prune_by_ingest_date(spark, tmp_shared):
    from sensorflow.functions.time import since
    from sensorflow.operators.monitoring import ingest_lag
    from sensorflow.operators.reports import ingestion_rate
    m = _m(spark, [(d, s) for d in range(3) for s in range(5)]).withColumn("created_at", F.col("timestamp"))
    p = tmp_shared("fact")
    SK.write_measurements(m, p, batch_id=1, by_ingest_date=True)
    back = spark.read.parquet(p)
    # the lag is written once for its quantile, so its read is looked at where it starts
    for out in (ingestion_rate(back, T0, "10 minutes"), since(back, T0, "10 minutes", col="created_at", date_col="ingest_date")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert sum(r.rows for r in ingest_lag(back, "1 hour", as_of=T0, lookback="10 minutes").collect()) == 5
    assert sum(r.records_inserted for r in ingestion_rate(back, T0, "10 minutes").collect()) == 5
