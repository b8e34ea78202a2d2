import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorflow.operators import timeseries as TS
from sensorflow.operators.quality import parse_readings
from sensorflow.sources.messages import read_messages
from sensorflow.sources.testdata import TestTables, messages_from_events, write_landing
from sensorflow.streaming import ingest as IG
from sensorflow.streaming import rollup as RU

SF = "/root/testdata/sf0.001"


def test_stream_rollup_equals_batch_with_late_readings_and_the_last_window(spark, tmp_shared):
    t = TestTables(spark, SF)
    root = tmp_shared("roll")
    # one file per trigger, the latest readings first: all later files are late
    msgs = messages_from_events(t.events, damaged=False, key="event_type").withColumn(
        "_f", -F.ntile(4).over(Window.orderBy("arrival_time")))
    for k in (-4, -3, -2, -1):
        write_landing(msgs.filter(F.col("_f") == k).drop("_f"), f"{root}/in/{k + 4}", files=1)
    stream = parse_readings(read_messages(spark, f"{root}/in/*", streaming=True, max_files_per_trigger=1))
    stream = stream.filter(F.col("error_class").isNull()).select("sensor_id", "timestamp", "value")
    q = RU.start_rollup(stream, f"{root}/out", f"{root}/ck", "1 hour", trigger={"availableNow": True})
    q.awaitTermination()
    assert len(q.recentProgress) >= 4
    got = RU.read_rollup(spark, f"{root}/out")
    batch = TS.resample(parse_readings(read_messages(spark, f"{root}/in/*")).filter(F.col("error_class").isNull())
                        .withColumn("quality_flag", F.lit("valid")), "1 hour")
    cols = ["sensor_id", "timestamp", "sample_count", "min_value", "max_value"]
    assert got.count() == batch.count()
    assert got.select(*cols).exceptAll(batch.select(*cols)).count() == 0


def test_ingest_stream_is_idempotent_and_loses_nothing(spark, tmp_shared):
    t = TestTables(spark, SF)
    root = tmp_shared("ing")
    msgs = messages_from_events(t.events)
    write_landing(msgs, f"{root}/in", files=4)
    q = IG.start_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/ck", lambda: t.sensors,
                        trigger={"availableNow": True}, max_files_per_trigger=2)
    q.awaitTermination()
    meas = spark.read.parquet(f"{root}/out/measurements")
    quar = spark.read.parquet(f"{root}/out/quarantine")
    n_in = msgs.count()
    assert meas.count() + quar.count() == n_in
    assert spark.read.text(f"{root}/out/raw").count() == n_in
    alerts = spark.read.parquet(f"{root}/out/alerts")
    assert alerts.agg(F.sum("messages")).first()[0] == n_in


def test_replayed_batch_replaces_its_own_output(spark, tmp_shared):
    """A batch run twice (a retry after a crash before the stream committed) lands once."""
    t = TestTables(spark, SF)
    root = tmp_shared("replay")
    write_landing(messages_from_events(t.events), f"{root}/in", files=4)
    batch = read_messages(spark, f"{root}/in")
    IG.process_batch(batch, t.sensors, f"{root}/out", 7)
    IG.process_batch(read_messages(spark, f"{root}/in").limit(10), t.sensors, f"{root}/out", 8)
    first = {k: spark.read.parquet(f"{root}/out/{k}").count() for k in ("measurements", "quarantine", "alerts")}
    first["raw"] = spark.read.text(f"{root}/out/raw").count()
    IG.process_batch(batch, t.sensors, f"{root}/out", 7)
    again = {k: spark.read.parquet(f"{root}/out/{k}").count() for k in ("measurements", "quarantine", "alerts")}
    again["raw"] = spark.read.text(f"{root}/out/raw").count()
    assert first == again
    assert first["alerts"] == 2


def test_dedupe_stream(spark, tmp_shared):
    root = tmp_shared("dd")
    base = dt.datetime(2024, 1, 1)
    rows = [f'{{"sensor_id":"a","timestamp":"{(base + dt.timedelta(seconds=k)).isoformat()}Z","value":1,"unit":"C"}}'
            for k in range(20)]
    spark.createDataFrame([(r,) for r in rows + rows[:5]], "value string").coalesce(1).write.text(f"{root}/in")
    s = parse_readings(read_messages(spark, f"{root}/in", streaming=True)).filter(F.col("error_class").isNull())
    d = RU.dedupe_stream(s.select("sensor_id", "timestamp", "value"), delay="1 hour")
    q = (d.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 20


def test_rollup_from_fact_table_and_dq_sink(spark, tmp_shared):
    from sensorflow.operators import monitoring as MO
    from sensorflow.sources import sinks as SK
    t = TestTables(spark, SF)
    root = tmp_shared("factroll")
    SK.write_measurements(t.m_type, f"{root}/fact", batch_id=0)
    q = RU.start_rollup_from_table(spark, f"{root}/fact", f"{root}/roll", f"{root}/ck", "1 hour", trigger={"availableNow": True})
    q.awaitTermination()
    assert RU.read_rollup(spark, f"{root}/roll").count() == TS.resample(t.m_type, "1 hour").count()
    dq = MO.dq_metrics(t.sensors, t.m_user, t.as_of, "7 days", expected=16)
    SK.write_data_quality(dq, f"{root}/dq")
    SK.write_data_quality(dq, f"{root}/dq")  # re-run of the same check date replaces it
    assert spark.read.parquet(f"{root}/dq").count() == dq.count()


def test_restart_from_checkpoint_lands_each_message_once(spark, tmp_shared):
    t = TestTables(spark, SF)
    root = tmp_shared("restart")
    msgs = messages_from_events(t.events)
    day = F.to_date("arrival_time")
    first_half = msgs.filter(day < F.lit("2024-01-15"))
    second_half = msgs.filter(day >= F.lit("2024-01-15"))
    write_landing(first_half, f"{root}/in/a", files=2)

    def run():
        q = IG.start_ingest(spark, f"{root}/in/*", f"{root}/out", f"{root}/ck", lambda: t.sensors,
                            trigger={"availableNow": True}, max_files_per_trigger=1)
        q.awaitTermination()

    run()
    n1 = spark.read.parquet(f"{root}/out/measurements").count() + spark.read.parquet(f"{root}/out/quarantine").count()
    assert n1 == first_half.count()
    write_landing(second_half, f"{root}/in/b", files=2)
    run()  # a restarted query: resumes from its checkpoint, only the new files are read
    meas = spark.read.parquet(f"{root}/out/measurements")
    quar = spark.read.parquet(f"{root}/out/quarantine")
    assert meas.count() + quar.count() == msgs.count()
    assert meas.groupBy("id").count().filter("count > 1").count() == 0


def test_refreshing_dimension_reloads_after_ttl(spark):
    calls, clock = [], [0.0]

    def load():
        calls.append(1)
        return spark.range(3)

    get = IG.refreshing(load, ttl_seconds=60, clock=lambda: clock[0])
    a = get()
    clock[0] = 30
    assert get() is a and len(calls) == 1
    clock[0] = 61
    assert get() is not a and len(calls) == 2


def test_quarantined_unknown_sensors_land_after_the_dimension_learns_them(spark, tmp_shared):
    t = TestTables(spark, SF)
    root = tmp_shared("requar")
    msgs = messages_from_events(t.events)
    IG.process_batch(msgs, t.sensors, f"{root}/out", 0)
    meas0 = spark.read.parquet(f"{root}/out/measurements").count()
    unknown = spark.read.parquet(f"{root}/out/quarantine").filter(F.col("error_class") == "unknown_sensor").count()
    assert unknown > 0
    from sensorflow.sources.testdata import sensors_from_customers
    everyone = sensors_from_customers(t.raw("customer"), t.raw("nation"), only_registered=False)
    landed = IG.replay_quarantine(spark, f"{root}/out", everyone, batch_id=1)
    assert landed == unknown
    assert spark.read.parquet(f"{root}/out/measurements").count() == meas0 + unknown
    # running the same replay again replaces batch 1, it does not add to it
    IG.replay_quarantine(spark, f"{root}/out", everyone, batch_id=1)
    assert spark.read.parquet(f"{root}/out/measurements").count() == meas0 + unknown


def test_error_rate_stream_matches_batch_on_closed_windows(spark, tmp_shared):
    from pyspark.sql import types as T

    from sensorflow.operators.monitoring import error_rate
    t = TestTables(spark, SF)
    root = tmp_shared("errs")
    msgs = messages_from_events(t.events)
    msgs.write.parquet(f"{root}/in")
    schema = T.StructType([f for f in msgs.schema.fields])
    stream = parse_readings(spark.readStream.schema(schema).parquet(f"{root}/in"))
    q = (RU.error_rate_stream(stream, "1 day", "0 seconds", limit=0.2).writeStream.format("parquet")
         .option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{root}/out")
    batch = error_rate(parse_readings(msgs), "1 day", limit=0.2)
    last = batch.agg(F.max("window_start")).first()[0]
    closed = batch.filter(F.col("window_start") < F.lit(last))
    cols = ["window_start", "messages", "errors", "alert"]
    assert got.count() == closed.count() > 0
    assert got.select(*cols).subtract(closed.select(*cols)).count() == 0


def test_replay_of_the_raw_archive_keeps_ids_and_error_classes(spark, tmp_shared):
    t = TestTables(spark, SF)
    root = tmp_shared("rawids")
    lines = ['{"sensor_id": "1", "timestamp": 1704103200, "value": 12.50, "unit": "C"}', '{"unit":"C","sensor_id":"1","timestamp":1704103201,"value":1.0}',
             '{"sensor_id": 7, "timestamp": 1704103200, "value": 1, "unit": "C"}', '{"sensor_id": "a",', "not json", "[1, 2]"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/in")
    IG.run_batch_ingest(spark, f"{root}/in", f"{root}/out", t.sensors)
    first = IG.parse_batch(read_messages(spark, f"{root}/in"))
    again = IG.parse_batch(read_messages(spark, f"{root}/out/raw"))
    cols = ["id", "body", "error_class", "error_field", "value"]
    assert sorted(first.select(*cols).collect(), key=str) == sorted(again.select(*cols).collect(), key=str)


def test_quarantine_replay_lands_each_reading_once(spark, tmp_shared):
    t = TestTables(spark, SF)
    root = tmp_shared("requar")
    IG.process_batch(messages_from_events(t.events), t.sensors.filter("pmod(xxhash64(sensor_id), 2) = 0"), root, 0)
    n = IG.replay_quarantine(spark, root, t.sensors, batch_id=1)
    assert n > 0 and IG.replay_quarantine(spark, root, t.sensors, batch_id=1) == n  # the same batch again
    facts = spark.read.parquet(f"{root}/measurements").count()
    assert IG.replay_quarantine(spark, root, t.sensors, batch_id=2) == 0
    assert spark.read.parquet(f"{root}/measurements").count() == facts


def test_dedupe_keeps_late_readings_and_survives_a_replay(spark, tmp_shared):
    from sensorflow.streaming.rollup import start_dedupe
    land, out, ckpt = tmp_shared("land"), tmp_shared("out"), tmp_shared("ckpt")
    schema = "sensor_id string, timestamp timestamp_ntz, value double"
    t = dt.datetime(2024, 3, 10)
    batches = [[("a", t, 1.0), ("a", t, 0.5), ("b", t, 2.0)],
               [("a", t, 9.0), ("a", t - dt.timedelta(days=400), 3.0)],  # a repeat, and a very late reading
               [("a", t - dt.timedelta(days=400), 4.0), ("c", t, 5.0)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(land)
        q = start_dedupe(spark.readStream.schema(schema).parquet(land), out, ckpt, trigger={"availableNow": True})
        q.awaitTermination()
    got = sorted((r.sensor_id, r.timestamp, r.value) for r in spark.read.parquet(out).collect())
    assert got == sorted([("a", t, 0.5), ("b", t, 2.0), ("a", t - dt.timedelta(days=400), 3.0), ("c", t, 5.0)])


def test_landing_lines_with_bare_nan(spark):
    from sensorflow.sources.messages import messages_from_lines
    lines = ['{"sensor_id":"a b","value":NaN}', '{"topic":"t/x","payload":{"sensor_id":"a","value":-Infinity}}', '{"sens']
    got = [(r.topic, r.body) for r in messages_from_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()]
    assert got == [("sensors/a_b", lines[0]), ("t/x", '{"sensor_id":"a","value":-Infinity}'), (None, lines[2])]


# ---------------------------------------------------------------- ids, compaction and replays of a streamed table

def _line(sensor, second, value=20.0):
    return f'{{"sensor_id":"{sensor}","timestamp":{1709300000 + second},"value":{value},"unit":"C"}}'


def _land(path, name, lines):
    import os
    from sensorflow.session import local_path
    os.makedirs(local_path(path), exist_ok=True)
    with open(f"{local_path(path)}/{name}", "w") as f:
        f.write("".join(x + "\n" for x in lines))


def _sensors(spark, *names):
    return spark.createDataFrame([(n, "L", "t", "C", 0.0, 50.0) for n in names],
                                 "sensor_id string, location string, sensor_type string, unit string, min_value double, max_value double")


def _ingest(spark, root, sensors, **kwargs):
    q = IG.start_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/ck", lambda: sensors, trigger={"availableNow": True}, **kwargs)
    q.awaitTermination()
    return q


def test_equal_lines_have_ids_of_their_own_stable_over_a_replay(spark, tmp_shared):
    root = tmp_shared("ids")
    _land(f"{root}/in", "one", [_line("a", 0)] * 3 + [_line("b", 1), "{broken", "{broken"])
    _land(f"{root}/in", "two", [_line("a", 0)])
    sensors = _sensors(spark, "a")
    _ingest(spark, root, sensors)
    facts = spark.read.parquet(f"{root}/out/measurements")
    ids = sorted(r.id for r in facts.collect())
    assert len(ids) == len(set(ids)) == 4
    quarantined = [r.id for r in spark.read.parquet(f"{root}/out/quarantine").collect()]
    assert len(quarantined) == len(set(quarantined) - set(ids)) == 3
    IG.process_batch(read_messages(spark, f"{root}/in"), sensors, f"{root}/out", 0)  # the batch again
    assert sorted(r.id for r in spark.read.parquet(f"{root}/out/measurements").collect()) == ids
    IG.process_batch(read_messages(spark, f"{root}/out/raw"), sensors, f"{root}/again", 0)  # from the archive
    assert sorted(r.id for r in spark.read.parquet(f"{root}/again/measurements").collect()) == ids


def test_a_line_that_fills_a_third_of_a_batch_is_numbered_per_task(spark, tmp_shared):
    root = tmp_shared("hotline")
    for f in range(6):
        _land(f"{root}/in", f"f{f}", [_line("a", s) for s in range(50)] + [_line("a", 7)] * 60)
    lines = read_messages(spark, f"{root}/in").withColumn("ingest_file", F.lit("x"))  # as if of one file
    IG.process_batch(lines, _sensors(spark, "a"), f"{root}/out", 0)
    facts = spark.read.parquet(f"{root}/out/measurements")
    assert facts.count() == facts.select("id").distinct().count() == 660


def test_a_started_ingest_drops_what_a_lost_driver_left_staged(spark, tmp_shared):
    import os
    from sensorflow.session import local_path
    root = tmp_shared("leftover")
    for name in ("7-abc", "replay-1-abc"):
        spark.range(3).write.parquet(f"{root}/out/_staging/{name}")
    _land(f"{root}/in", "f", [_line("a", 1)])
    _ingest(spark, root, _sensors(spark, "a"))
    assert os.listdir(local_path(f"{root}/out/_staging")) == ["replay-1-abc"]
    assert spark.read.parquet(f"{root}/out/measurements").count() == 1


def test_replay_after_compaction_lands_nothing_twice(spark, tmp_shared):
    from sensorflow.sources.tables import COMPACTED, compact_table
    root = tmp_shared("comprep")
    for f in range(6):
        _land(f"{root}/in", f"f{f}", [_line("a", f), _line("a", f)])
    sensors = _sensors(spark, "a")
    _ingest(spark, root, sensors, max_files_per_trigger=1)
    facts = f"{root}/out/measurements"
    assert spark.read.parquet(facts).select("batch_id").distinct().count() == 6
    before = sorted(spark.read.parquet(facts).select("id", "timestamp").collect())
    assert len(compact_table(spark, facts)) == 1
    assert len(spark.read.parquet(facts).inputFiles()) == 1
    IG.process_batch(read_messages(spark, f"{root}/in/f5"), sensors, f"{root}/out", 5)  # replayed: found by its ids
    assert sorted(spark.read.parquet(facts).select("id", "timestamp").collect()) == before
    assert {r.batch_id for r in spark.read.parquet(facts).collect()} == {COMPACTED}
    _land(f"{root}/in", "f6", [_line("a", 99)])
    _ingest(spark, root, sensors)
    assert spark.read.parquet(facts).count() == len(before) + 1


def test_the_dimension_is_joined_once_and_replay_is_pruned(spark, tmp_shared):
    root = tmp_shared("prune")
    lines = [_line("a", 86400 * d) for d in range(5)] + [_line("b", 86400 * 3 + 5)]
    _land(f"{root}/in", "f", lines)
    _ingest(spark, root, _sensors(spark, "a"))
    plan = IG.flag_batch(IG.parse_batch(read_messages(spark, f"{root}/in")), _sensors(spark, "a"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    meas, _ = IG.readings_from_messages(read_messages(spark, f"{root}/in").filter("body like '%\"b\"%'"), _sensors(spark, "a", "b"))
    plan = IG.unlanded(meas, f"{root}/out/measurements", 9)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert len(scans) == 1 and "PartitionFilters: [isnotnull(" in scans[0].replace("PartitionFilters: [event_date", "PartitionFilters: [isnotnull(") \
        and "event_date" in scans[0].split("PartitionFilters")[1] and "2024-03-04" in scans[0]
    assert IG.replay_quarantine(spark, f"{root}/out", _sensors(spark, "a", "b"), 1) == 1
    assert IG.replay_quarantine(spark, f"{root}/out", _sensors(spark, "a", "b"), 2) == 0


def test_batches_are_bounded_by_bytes_and_finished_files_leave_the_landing_folder(spark, tmp_shared):
    import os
    from sensorflow.session import local_path
    root = tmp_shared("flush")
    for f in range(6):
        _land(f"{root}/in", f"f{f}", [_line("a", 100 * f + i) for i in range(40)])
    size = os.path.getsize(f"{local_path(root)}/in/f0")
    # archiving follows one batch behind, and the last batch's files stay
    _ingest(spark, root, _sensors(spark, "a"), max_bytes_per_trigger=2 * size + 10, archive_read_files=f"{root}/done")
    per_batch = spark.read.parquet(f"{root}/out/measurements").groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in per_batch) == [80, 80, 80]
    left, done = (sum(len(fs) for _, _, fs in os.walk(f"{local_path(root)}/{d}")) for d in ("in", "done"))
    assert left + done == 6 and done >= 2


# ---------------------------------------------------------------- rollup by date, folded and closed

def _rollup_files(path):
    import os
    from sensorflow.session import local_path
    return sorted(os.path.relpath(os.path.join(d, f), local_path(path)) for d, _, fs in os.walk(local_path(path)) for f in fs if f.endswith(".parquet"))


def test_rollup_folds_closes_and_reads_one_day(spark, tmp_shared):
    root = tmp_shared("cascade")
    t = dt.datetime(2024, 3, 10)
    schema = "sensor_id string, timestamp timestamp_ntz, value double"
    rows = [(s, t + dt.timedelta(days=d, minutes=7 * i), float(i * d + 1)) for s in "ab" for d in range(3) for i in range(60)]

    def start():
        q = RU.start_rollup(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in"), f"{root}/roll", f"{root}/ck",
                            trigger={"availableNow": True}, fold_every=3)
        q.awaitTermination()
    for part in range(8):
        spark.createDataFrame(rows[part::8], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    start()

    def check(extra=()):
        every = [*rows, *extra]
        for unit, cut in ((None, lambda x: x), ("hour", lambda x: x.replace(minute=0)), ("day", lambda x: x.replace(hour=0, minute=0))):
            want = {}
            for s, at, v in every:
                want.setdefault((s, cut(at)), []).append(v)
            got = {(r.sensor_id, r.timestamp): (r.avg_value, r.min_value, r.max_value, r.sample_count) for r in RU.read_rollup(spark, f"{root}/roll", unit).collect()}
            assert got.keys() == want.keys()
            for k, v in want.items():
                assert got[k][1:] == (min(v), max(v), len(v)) and abs(got[k][0] - sum(v) / len(v)) < 1e-9
            one = RU.read_rollup(spark, f"{root}/roll", unit, dates=[(t + dt.timedelta(days=1)).date()])
            assert {r.timestamp.date() for r in one.collect()} == {(t + dt.timedelta(days=1)).date()}
    check()
    assert len(_rollup_files(f"{root}/roll")) <= 3 * 4  # folded as it went: at most three batches and the folded ones a date
    assert RU.close_rollup(spark, f"{root}/roll", (t + dt.timedelta(days=2)).date()) == ["2024-03-10", "2024-03-11"]
    files = _rollup_files(f"{root}/roll")
    assert sum("2024-03-11" in f for f in files) == 3  # windows, hours and days, one file each
    check()
    plan = RU.read_rollup(spark, f"{root}/roll", None, dates=[t.date()])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "PartitionFilters: [event_date" in plan
    late = [("a", t + dt.timedelta(minutes=3), -5.0), ("c", t, 1.0)]  # for a closed date
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    start()
    check(late)
    assert RU.close_rollup(spark, f"{root}/roll", (t + dt.timedelta(days=2)).date()) == ["2024-03-10"]
    check(late)
    assert RU.close_rollup(spark, f"{root}/roll", (t + dt.timedelta(days=2)).date()) == []


def test_a_lost_close_is_made_good(spark, tmp_shared, monkeypatch):
    import pytest
    root = tmp_shared("lostclose")
    t = dt.datetime(2024, 3, 10)
    df = spark.createDataFrame([("a", t + dt.timedelta(minutes=i), float(i)) for i in range(200)], "sensor_id string, timestamp timestamp_ntz, value double")
    for b in range(3):
        RU._land_partials(df.filter(F.minute("timestamp") % 3 == b), root, b, "1 minute")
    want = sorted(RU.read_rollup(spark, root, "hour").collect())
    with monkeypatch.context() as mp:
        mp.setattr(RU, "coarsened", lambda df, unit=None, f=RU.coarsened: f(df, unit) if unit is None else 1 / 0)
        with pytest.raises(ZeroDivisionError):  # lost after the windows were rewritten
            RU.close_rollup(spark, root, dt.date(2024, 3, 11))
    assert sorted(RU.read_rollup(spark, root, "hour").collect()) == want
    RU.close_rollup(spark, root, dt.date(2024, 3, 11))
    assert sorted(RU.read_rollup(spark, root, "hour").collect()) == want and "hour" in " ".join(_rollup_files(root))


def test_rollup_from_a_compacted_fact_table(spark, tmp_shared):
    from sensorflow.sources import sinks as SK
    from sensorflow.sources.tables import compact_table
    t = TestTables(spark, SF)
    root = tmp_shared("compfact")
    parts = [t.m_type.filter(F.col("id") % 3 == k) for k in range(3)]
    for k in (0, 1):
        SK.write_measurements(parts[k], f"{root}/fact", batch_id=k)

    def run():
        RU.start_rollup_from_table(spark, f"{root}/fact", f"{root}/roll", f"{root}/ck", "1 hour", trigger={"availableNow": True}).awaitTermination()
        return RU.read_rollup(spark, f"{root}/roll").agg(F.sum("sample_count")).first()[0]
    compact_table(spark, f"{root}/fact")
    assert run() == parts[0].count() + parts[1].count()
    SK.write_measurements(parts[2], f"{root}/fact", batch_id=2)
    compact_table(spark, f"{root}/fact", before_date="2024-01-10")
    after = run()
    recent = parts[2].filter(F.col("timestamp") >= F.lit("2024-01-10").cast("timestamp_ntz")).count()
    assert parts[0].count() + parts[1].count() + recent <= after <= t.m_type.count()


def _lines(spark, n):
    body = F.concat(F.lit('{"sensor_id": "a", "value": 1, "unit": "C", "timestamp": '), (F.col("id") * 86400).cast("string"), F.lit("}"))
    return spark.range(n, numPartitions=1).select(body.alias("value"))


def test_one_landed_file_is_decoded_by_many_tasks(spark, tmp_shared):
    root = tmp_shared("spread")
    _lines(spark, 200).write.text(f"{root}/in")
    parts = []

    def look(sink, batch):
        if sink == "measurements":
            parts.append(spark.read.parquet(f"{root}/out/_staging/*").select("_part").distinct().count())
    spark.createDataFrame([("a", 0.0, 9.0)], "sensor_id string, min_value double, max_value double").write.parquet(f"{root}/dim")
    sensors = spark.read.parquet(f"{root}/dim")  # of a known size: broadcast, so that the join deals no rows
    IG.start_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/ck", lambda: sensors, trigger={"availableNow": True},
                    after_sink=look).awaitTermination()
    assert parts and min(parts) > 1
    assert spark.read.parquet(f"{root}/out/measurements").count() == 200


def test_survey_finds_shared_ids_and_every_date(spark):
    rows = [(1, None, "2024-01-02 10:00:00"), (2, None, "2024-01-01 10:00:00"), (3, 7, None), (3, 7, "2024-01-02 11:00:00")]
    df = spark.createDataFrame(rows, "id long, msg_id long, ts string").select("id", "msg_id", F.col("ts").cast("timestamp_ntz").alias("timestamp"))
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert IG.survey(df) == (False, days)  # messages that bring an id may share it
    assert IG.survey(df.drop("msg_id")) == (True, days)
    assert IG.survey(df.filter("false")) == (False, [])
