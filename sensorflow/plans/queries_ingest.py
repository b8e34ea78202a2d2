"""Named queries for ingest, validation, storage and streaming over the test tables.

Round-trip queries write to a fresh folder under the shared checkpoint root
(``spark.checkpoint.dir``) and return what a reader sees afterwards.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sensorflow.operators import quality as Q
from sensorflow.operators import timeseries as TS
from sensorflow.plans.registry import _t, register, round_doubles
from sensorflow.session import scratch_dir
from sensorflow.sources import messages as MS
from sensorflow.sources import sensors as SN
from sensorflow.sources import sinks as SK
from sensorflow.sources import tables as TB
from sensorflow.sources.files import list_files
from sensorflow.sources.testdata import messages_from_events, sensors_from_customers, write_landing
from sensorflow.streaming import ingest as IG
from sensorflow.streaming import rollup as RU

MEAS_COLS = ["id", "sensor_id", "timestamp", "value", "quality_flag", "created_at"]


def _parsed(spark, sf_dir):
    t = _t(spark, sf_dir)
    return Q.parse_readings(messages_from_events(t.events))


def replayed(t):
    """The fact table plus a re-delivered slice (every 10th reading, landed an hour later)."""
    again = t.m_user.filter(F.col("id") % 10 == 0).withColumn(
        "created_at", F.timestamp_add("HOUR", F.lit(1), F.col("created_at")))
    return t.m_user.unionByName(again)


# ------------------------------------------------------------------ V1 V2 V4 V5

@register("validate_readings")
def q_validate_readings(spark, sf_dir):
    # doubles rounded like every other query; what is not finite becomes NULL there and is named beside
    v = F.col("value")
    kind = F.when(F.isnan(v), "nan").when(F.abs(v) == float("inf"), "infinite").when(v.isNotNull(), "finite")
    return round_doubles(_parsed(spark, sf_dir).select("msg_id", "sensor_id", "timestamp", "value", kind.alias("value_kind"), "unit",
                                                       "error_class", "error_field"))


@register("split_counts")
def q_split_counts(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return p.groupBy(F.coalesce("error_class", F.lit("valid")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages"))


@register("quarantine_rows")
def q_quarantine_rows(spark, sf_dir):
    _, rejected = Q.split_valid(_parsed(spark, sf_dir))
    return Q.quarantine(rejected).select("msg_id", "error_class", "error_field")


# ------------------------------------------------------------------ V3 V6 V7 V9 F14

@register("flag_quality")
def q_flag_quality(spark, sf_dir):
    return round_doubles(_t(spark, sf_dir).m_user)


@register("orphans")
def q_orphans(spark, sf_dir):
    t = _t(spark, sf_dir)
    return Q.check_orphans(t.m_user, t.sensors)


@register("key_check")
def q_key_check(spark, sf_dir):
    return Q.check_keys(replayed(_t(spark, sf_dir)), ["id"])


@register("not_null_check")
def q_not_null_check(spark, sf_dir):
    return Q.check_not_null(_t(spark, sf_dir).m_user, MEAS_COLS)


@register("duplicates")
def q_duplicates(spark, sf_dir):
    return Q.find_duplicates(replayed(_t(spark, sf_dir)))


@register("dedupe")
def q_dedupe(spark, sf_dir):
    return round_doubles(Q.dedupe(replayed(_t(spark, sf_dir))))


@register("clamp_to_range")
def q_clamp_to_range(spark, sf_dir):
    t = _t(spark, sf_dir)
    from sensorflow.sources.testdata import raw_measurements
    return round_doubles(Q.clamp_to_range(raw_measurements(t.events), t.sensors))


# ------------------------------------------------------------------ S2 S5 S9 S10

@register("topic_filter")
def q_topic_filter(spark, sf_dir):
    msgs = messages_from_events(_t(spark, sf_dir).events)
    return MS.filter_topic(msgs, "sensors/click/#").select("msg_id", "topic")


@register("topic_filter_level")
def q_topic_filter_level(spark, sf_dir):
    msgs = messages_from_events(_t(spark, sf_dir).events)
    return MS.filter_topic(msgs, "sensors/+/7").select("msg_id", "topic")


@register("wide_measurements")
def q_wide_measurements(spark, sf_dir):
    # every reading, with epoch-second times as the second ingest path expects
    msgs = messages_from_events(_t(spark, sf_dir).events, damaged=False, time_format="epoch")
    return round_doubles(SK.to_wide_measurements(msgs, keep=["msg_id"]))


@register("insert_if_absent")
def q_insert_if_absent(spark, sf_dir):
    t = _t(spark, sf_dir)
    candidates = sensors_from_customers(t.raw("customer"), t.raw("nation"), only_registered=False)
    return SN.insert_if_absent(candidates, t.sensors)


@register("sensor_catalog")
def q_sensor_catalog(spark, sf_dir):
    t = _t(spark, sf_dir)
    path = scratch_dir(spark, "catalog")
    key = F.col("sensor_id").cast("int")
    placed = t.sensors.withColumns({"lat": (key % 90).cast("double"), "lng": (key % 180).cast("double")})
    SN.write_sensor_catalog(placed, path, sensors_per_file=5000)
    return SN.read_sensor_catalog(spark, path, multi_line=False).select(
        "sensor_id", "sensor_type", "unit", "min_value", "max_value", "lat", "lng", "description")


@register("sensor_table")
def q_sensor_table(spark, sf_dir):
    path = scratch_dir(spark, "sensors")
    _t(spark, sf_dir).sensors.write.parquet(path)
    return SN.read_sensors(spark, path)


@register("landing_topics")
def q_landing_topics(spark, sf_dir):
    """Messages per topic, of bare landing lines: the topic is the one their sensor id maps to."""
    path = scratch_dir(spark, "landing")
    write_landing(messages_from_events(_t(spark, sf_dir).events), path)
    return MS.read_messages(spark, path).groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@register("with_defaults")
def q_with_defaults(spark, sf_dir):
    t = _t(spark, sf_dir)
    gaps = t.m_user.withColumn("quality_flag", F.when(F.col("id") % 10 != 0, F.col("quality_flag"))) \
        .withColumn("created_at", F.when(F.col("id") % 4 != 0, F.col("created_at")))
    return round_doubles(Q.with_defaults(gaps, F.lit(t.as_of).cast("timestamp_ntz")))


@register("fact_layout")
def q_fact_layout(spark, sf_dir):
    """Readings and files of each (date, sensor) folder of a fact table with a sensor level."""
    root = scratch_dir(spark, "layout")
    SK.write_measurements(_t(spark, sf_dir).m_type, root, by_sensor=True)
    return spark.read.parquet(root).groupBy("event_date", "sensor_id").agg(
        F.count(F.lit(1)).alias("readings"), F.count_distinct(F.col("_metadata.file_path")).alias("files"))


@register("rollup_table")
def q_rollup_table(spark, sf_dir):
    root = scratch_dir(spark, "rollup")
    SK.write_rollup(TS.resample(_t(spark, sf_dir).m_type, "1 minute"), root)
    return round_doubles(spark.read.parquet(root))


# ------------------------------------------------------------------ S11 S12 S13 S14 S16

@register("export_csv")
def q_export_csv(spark, sf_dir):
    t = _t(spark, sf_dir)
    path = scratch_dir(spark, "export")
    SK.export_csv(t.m_user, t.sensors, path, t.as_of, "20 days")
    schema = ("sensor_id string, location string, sensor_type string, timestamp timestamp_ntz, "
              "value double, unit string, quality_flag string")
    back = spark.read.schema(schema).option("header", True).csv(path)
    return round_doubles(back)


@register("retention")
def q_retention(spark, sf_dir):
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "measurements")
    SK.write_measurements(t.m_user, root)
    TB.drop_expired(spark, root, t.as_of, keep="20 days")
    return round_doubles(spark.read.parquet(root).select(*MEAS_COLS))


@register("compact")
def q_compact(spark, sf_dir):
    """Every reading, and the number of files its date is stored in after many small ones were folded."""
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "measurements")
    loose = t.m_user.withColumn("event_date", F.to_date("timestamp")).repartition(16)
    loose.write.partitionBy("event_date").parquet(root)
    TB.compact_table(spark, root)
    back = spark.read.parquet(root)
    files = back.groupBy("event_date").agg(F.count_distinct(F.col("_metadata.file_path")).alias("files"))
    return round_doubles(back.join(files, "event_date").select(*MEAS_COLS, "files"))


@register("table_stats")
def q_table_stats(spark, sf_dir):
    return TB.table_stats(spark, f"{sf_dir.rstrip('/')}/events.parquet", "events")


@register("raw_replay")
def q_raw_replay(spark, sf_dir):
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "replay")
    msgs = messages_from_events(t.events)
    SK.write_raw(msgs, f"{root}/raw", F.col("arrival_time"))
    back = MS.read_messages(spark, f"{root}/raw")
    meas, _ = IG.readings_from_messages(back, t.sensors)
    return round_doubles(meas.select("sensor_id", "timestamp", "value", "quality_flag", "created_at"))


@register("raw_replay_quarantine")
def q_raw_replay_quarantine(spark, sf_dir):
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "replay")
    msgs = messages_from_events(t.events)
    SK.write_raw(msgs, f"{root}/raw", F.col("arrival_time"))
    _, quar = IG.readings_from_messages(MS.read_messages(spark, f"{root}/raw"), t.sensors)
    return quar.groupBy("error_class", "error_field").agg(F.count(F.lit(1)).alias("messages"))


# ------------------------------------------------------------------ T1 T5

@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "stream")
    write_landing(messages_from_events(t.events), f"{root}/landing", files=8)
    q = IG.start_ingest(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", lambda: t.sensors,
                        trigger={"availableNow": True}, max_files_per_trigger=3)
    q.awaitTermination()
    return round_doubles(spark.read.parquet(f"{root}/out/measurements")
                         .select("sensor_id", "timestamp", "value", "quality_flag"))


def _streamed(spark, t, root, messages=None, **kwargs):
    """Land the messages in files by arrival and ingest them in micro-batches of up to two files."""
    write_landing(messages_from_events(t.events) if messages is None else messages, f"{root}/landing", files=8)
    kwargs = {"max_files_per_trigger": 2, **kwargs}
    IG.start_ingest(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", lambda: t.sensors, trigger={"availableNow": True},
                    **kwargs).awaitTermination()
    return f"{root}/out/measurements"


@register("compact_stream")
def q_compact_stream(spark, sf_dir):
    """Readings of a streamed fact table after compaction, with the files and batch folders of their date: one each."""
    t = _t(spark, sf_dir)
    facts = _streamed(spark, t, scratch_dir(spark, "comps"))
    TB.compact_table(spark, facts)
    back = spark.read.parquet(facts)
    dates = back.groupBy("event_date").agg(F.count_distinct(F.col("_metadata.file_path")).alias("files"),
                                           F.count_distinct("batch_id").alias("batches"))
    return round_doubles(back.join(dates, "event_date").select("sensor_id", "timestamp", "value", "quality_flag", "files", "batches"))


@register("stream_ids")
def q_stream_ids(spark, sf_dir):
    """Readings and ids of each sensor after every seventh line landed three times: each line has an id of its own."""
    t = _t(spark, sf_dir)
    msgs = messages_from_events(t.events, damaged=False)
    thrice = msgs.withColumn("_n", F.explode(F.when(F.col("msg_id") % 7 == 0, F.array(*map(F.lit, range(3)))).otherwise(F.array(F.lit(0))))).drop("_n")
    facts = _streamed(spark, t, scratch_dir(spark, "ids"), thrice)
    # what the key check reports, beside the readings
    again = Q.check_keys(spark.read.parquet(facts), ["id"]).agg(F.count(F.lit(1)).alias("repeated_ids"))
    per = spark.read.parquet(facts).groupBy("sensor_id").agg(F.count(F.lit(1)).alias("readings"), F.count_distinct("id").alias("ids"))
    return per.join(F.broadcast(again))  # one row


@register("stream_fault")
def q_stream_fault(spark, sf_dir):
    """The streamed readings when the query fails between two sinks of its second batch and is started again."""
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "fault")

    def fail(sink, batch):
        if (sink, batch) == ("measurements", 1):
            raise RuntimeError("fault injected after the fact table was written")
    try:
        _streamed(spark, t, root, after_sink=fail)
    except StreamingQueryException:
        IG.start_ingest(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", lambda: t.sensors, trigger={"availableNow": True},
                        max_files_per_trigger=2).awaitTermination()
    facts = spark.read.parquet(f"{root}/out/measurements").select("id", "sensor_id", "timestamp", "value", "quality_flag")
    archived = spark.read.text(f"{root}/out/raw").agg(F.count(F.lit(1)).alias("archived"))  # one row
    return round_doubles(facts.drop("id").join(F.broadcast(archived)))


@register("stream_flush")
def q_stream_flush(spark, sf_dir):
    """Messages landed in batches bounded by bytes; how many batches were over the bound (none), and that there were several."""
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "flush")
    write_landing(messages_from_events(t.events), f"{root}/landing", files=9)
    bound = list_files(spark, f"{root}/landing", "*.txt").agg(F.max("length")).first()[0] * 3
    IG.start_ingest(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", lambda: t.sensors, trigger={"availableNow": True},
                    max_bytes_per_trigger=bound).awaitTermination()
    lines = MS.read_messages(spark, f"{root}/out/raw", keep=["batch_id"])
    per = lines.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("body") + 1).alias("bytes"))
    return per.agg(F.sum("n").alias("messages"), F.count_if(F.col("bytes") > bound).alias("batches_over"),
                   (F.count(F.lit(1)) > 1).alias("several_batches"))


@register("error_rate_stream")
def q_error_rate_stream(spark, sf_dir):
    """Error rates of the days that closed while an archive came in four slices, one micro-batch each.

    Slices are cut at 07:00, so windows span two of them and wait in the stream's state.
    """
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "rates")
    msgs = messages_from_events(t.events)
    lo, hi = msgs.agg(F.min("arrival_time"), F.max("arrival_time")).first()
    cuts = [lo, *[(lo + (hi - lo) * k / 4).replace(hour=7, minute=0, second=0, microsecond=0) for k in (1, 2, 3)], hi + dt.timedelta(seconds=1)]

    def run():
        parsed = Q.parse_readings(MS.read_messages(spark, f"{root}/landing", streaming=True))
        (RU.start_error_rate(parsed, f"{root}/out", f"{root}/ckpt", "1 day", "1 hour", limit=0.2, trigger={"availableNow": True})
         .awaitTermination())
    for a, b in zip(cuts, cuts[1:]):
        part = msgs.filter((F.col("arrival_time") >= F.lit(a)) & (F.col("arrival_time") < F.lit(b)))
        SK.raw_envelope(part, F.col("arrival_time")).select("value").write.mode("append").text(f"{root}/landing")
        run()
    return round_doubles(spark.read.parquet(f"{root}/out"))


@register("rollup_levels")
def q_rollup_levels(spark, sf_dir):
    """Hours and days of a streamed rollup whose older dates were closed and whose batches were folded."""
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "levels")
    write_landing(messages_from_events(t.events, damaged=False, key="event_type"), f"{root}/landing", files=8)
    readings = Q.parse_readings(MS.read_messages(spark, f"{root}/landing", streaming=True, max_files_per_trigger=1))
    readings = readings.filter(F.col("error_class").isNull()).select("sensor_id", "timestamp", "value")
    RU.start_rollup(readings, f"{root}/out", f"{root}/ckpt", "1 minute", trigger={"availableNow": True}, fold_every=3).awaitTermination()
    RU.close_rollup(spark, f"{root}/out", t.as_of.date())
    hours, days = (RU.read_rollup(spark, f"{root}/out", u).withColumn("unit", F.lit(u)) for u in ("hour", "day"))
    return round_doubles(hours.unionByName(days))


@register("stream_alerts")
def q_stream_alerts(spark, sf_dir):
    """The alert row that the streaming ingest lands for a micro-batch of archived messages."""
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "alerts")
    SK.write_raw(messages_from_events(t.events), f"{root}/landing", F.col("arrival_time"))
    q = IG.start_ingest(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", lambda: t.sensors,
                        trigger={"availableNow": True})
    q.awaitTermination()
    return round_doubles(spark.read.parquet(f"{root}/out/alerts").withColumn("batch_id", F.col("batch_id").cast("long")))


@register("resample_stream")
def q_resample_stream(spark, sf_dir):
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "rollup")
    write_landing(messages_from_events(t.events, damaged=False, key="event_type"), f"{root}/landing", files=8)
    readings = Q.parse_readings(MS.read_messages(spark, f"{root}/landing", streaming=True))
    readings = readings.filter(F.col("error_class").isNull()).select("sensor_id", "timestamp", "value")
    q = RU.start_rollup(readings, f"{root}/out", f"{root}/ckpt", "1 minute", trigger={"availableNow": True})
    q.awaitTermination()
    return round_doubles(RU.read_rollup(spark, f"{root}/out"))


# ------------------------------------------------------------------ T6

@register("dedupe_stream")
def q_dedupe_stream(spark, sf_dir):
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "dedupe")
    msgs = messages_from_events(t.events, damaged=False)
    again = msgs.filter(F.col("msg_id") % 10 == 0).withColumn(
        "arrival_time", F.timestamp_add("HOUR", F.lit(1), F.col("arrival_time")))
    write_landing(msgs.unionByName(again), f"{root}/landing", files=8)
    readings = Q.parse_readings(MS.read_messages(spark, f"{root}/landing", streaming=True))
    readings = readings.filter(F.col("error_class").isNull()).select("sensor_id", "timestamp", "value")
    q = RU.start_dedupe(readings, f"{root}/out", f"{root}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    return round_doubles(spark.read.parquet(f"{root}/out").select("sensor_id", "timestamp", "value"))


@register("quarantine_replay")
def q_quarantine_replay(spark, sf_dir):
    """Ingest against the registered sensors, then re-land the quarantined
    unknown-sensor readings once every customer is a known sensor."""
    t = _t(spark, sf_dir)
    root = scratch_dir(spark, "requar")
    IG.process_batch(messages_from_events(t.events), t.sensors, f"{root}/out", 0)
    everyone = sensors_from_customers(t.raw("customer"), t.raw("nation"), only_registered=False)
    IG.replay_quarantine(spark, f"{root}/out", everyone, batch_id=1)
    IG.replay_quarantine(spark, f"{root}/out", everyone, batch_id=2)  # lands nothing again
    return round_doubles(spark.read.parquet(f"{root}/out/measurements")
                         .select("sensor_id", "timestamp", "value", "quality_flag"))
