"""Ingest: landing messages -> raw archive + fact table + quarantine (T1-T3, T7).

``process_batch`` is the whole per-batch plan; the streaming query runs it in
``foreachBatch`` and a batch job (or a raw-archive replay) runs it directly.
Every sink write is keyed by ``batch_id`` with dynamic partition overwrite, so
a batch replayed after a failure replaces its own output; readings whose date
was compacted meanwhile are found there by their ids. With the stream's
checkpoint each message lands exactly once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorflow import schemas as S
from sensorflow.operators.joins import dim_join
from sensorflow.operators.monitoring import batch_alerts
from sensorflow.operators.quality import flag_quality, parse_readings
from sensorflow.sources.files import delete, exists, hadoop_path
from sensorflow.sources.messages import read_messages
from sensorflow.sources.sinks import write_measurements, write_raw
from sensorflow.sources.tables import COMPACTED

#: Tasks a core that decode a micro-batch: decoding costs far more than moving the lines.
SPREAD = 2


def _ingest_time(messages: DataFrame, ingest_time: Column | None) -> Column:
    if ingest_time is not None:
        return ingest_time
    now = F.current_timestamp().cast("timestamp_ntz")
    return F.coalesce(F.col("arrival_time"), now) if "arrival_time" in messages.columns else now


def parse_batch(messages: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Decode a batch once: message columns + reading columns + error class,
    ``created_at`` (ingest time) and a stable ``id``.

    The id is the supplied ``msg_id`` when present, else a content hash of
    (source file, body), which is the same on every recomputation. Equal lines
    of one file share it until ``number_copies`` tells them apart.
    """
    parsed = parse_readings(messages, "body").withColumn("created_at", _ingest_time(messages, ingest_time))
    file_col = F.col("ingest_file") if "ingest_file" in messages.columns else F.lit("")
    id_col = F.xxhash64(file_col, F.col("body"))
    if "msg_id" in messages.columns:
        id_col = F.coalesce(F.col("msg_id").cast("long"), id_col)
    return parsed.withColumn("id", id_col)


def flag_batch(parsed: DataFrame, sensors: DataFrame) -> DataFrame:
    """A parsed batch with ``quality_flag`` and what sends a message to quarantine, from one join with the dimension.

    ``reject_class`` / ``reject_field`` are the validator's error, or
    ``unknown_sensor`` / ``sensor_id`` for a valid reading of no known sensor
    (as the foreign key demands); both are NULL for readings that land.
    """
    flagged = flag_quality(parsed, sensors)
    valid = F.col("error_class").isNull()
    stray = valid & (F.col("quality_flag") == S.FLAG_UNKNOWN)
    return flagged.withColumns({
        "quality_flag": F.when(valid, F.col("quality_flag")),
        "reject_class": F.when(stray, F.lit(S.FLAG_UNKNOWN)).otherwise(F.col("error_class")),
        "reject_field": F.when(stray, F.lit("sensor_id")).otherwise(F.col("error_field"))})


def split_batch(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(measurements, quarantine) of a flagged batch; together they hold every message."""
    extra = [c for c in ("msg_id", "topic", "ingest_file") if c in flagged.columns]
    keep = flagged.filter(F.col("reject_class").isNull()).select(
        "id", "sensor_id", "timestamp", "value", "quality_flag", "created_at")
    bad = flagged.filter(F.col("reject_class").isNotNull()).select(
        *extra, "id", "body", F.col("reject_class").alias("error_class"), F.col("reject_field").alias("error_field"),
        "sensor_id", "timestamp", F.col("created_at").alias("quarantined_at"))
    return keep, bad


def route(parsed: DataFrame, sensors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a parsed batch into (measurements, quarantine).

    Measurements: id, sensor_id, timestamp, value, quality_flag, created_at, for
    known sensors only. Quarantine: every rejected message plus readings of
    unknown sensors, with an error class, so nothing is dropped and the rest of
    the batch still lands.
    """
    return split_batch(flag_batch(parsed, sensors))


def readings_from_messages(messages: DataFrame, sensors: DataFrame,
                           ingest_time: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse, validate and flag messages -> (measurements, quarantine)."""
    return route(parse_batch(messages, ingest_time), sensors)


def _hashed(batch: DataFrame) -> Column:
    """Messages whose id is a content hash."""
    return F.col("msg_id").isNull() if "msg_id" in batch.columns else F.lit(True)


def survey(batch: DataFrame) -> tuple[bool, list]:
    """Whether lines of a written batch share an id, and the dates of its readings (a row per date), in one job."""
    # fixed-width aggregates: a set of dates per id would be sorted on disk, a row per message
    most = batch.filter(_hashed(batch)).groupBy("id").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("_n"))
    dates = batch.select(F.to_date("timestamp").alias("_d")).filter("_d is not null").distinct()
    found = most.select("_n", F.lit(None).cast("date").alias("_d")).unionByName(dates.select(F.lit(None).cast("long").alias("_n"), "_d")).collect()
    return any((r["_n"] or 0) > 1 for r in found), sorted(r["_d"] for r in found if r["_d"])


def number_copies(batch: DataFrame) -> DataFrame:
    """Give equal lines of one file ids of their own (S7: one id a line).

    ``batch`` is a written table. The first copy keeps the content hash, the
    r-th is hashed with r; copies are alike, so any numbering gives the same
    readings and ids on every replay. Messages that carry an id keep it. Copies
    are numbered per task of the table's scan and shifted by the copies of the
    tasks before, so a line that makes up a third of a batch is not gathered in
    one.
    """
    own = _hashed(batch)
    many = batch.filter(own).groupBy("id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("id")
    part = F.col("_part")
    single = batch.join(many, "id", "left_anti") if "msg_id" not in batch.columns else \
        batch.filter(~own).unionByName(batch.filter(own).join(many, "id", "left_anti"))
    copies = batch.filter(own).join(many, "id", "left_semi")
    before = Window.partitionBy("id").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = copies.groupBy("id", "_part").count().select("id", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    rank = F.row_number().over(Window.partitionBy("id", "_part").orderBy("created_at")) + F.col("_shift")
    file_col = F.col("ingest_file") if "ingest_file" in batch.columns else F.lit("")
    named = copies.join(shifts, ["id", "_part"]).withColumn("_rank", rank).withColumn("id", F.when(
        F.col("_rank") > 1, F.xxhash64(file_col, F.col("body"), F.col("_rank"))).otherwise(F.col("id")))
    return single.unionByName(named.select(*single.columns))


def not_compacted(meas: DataFrame, facts_path: str, dates: list) -> DataFrame:
    """Readings of a batch that compaction has not already taken from an earlier run of it.

    Only compacted folders of the batch's own dates are looked into, and only
    their ids; usually there are none, since closed dates are compacted.
    """
    spark = meas.sparkSession
    dates = [d for d in dates if exists(spark, f"{facts_path}/event_date={d}/batch_id={COMPACTED}")]
    if not dates:
        return meas
    landed = spark.read.parquet(facts_path).filter(F.col("event_date").isin(dates) & (F.col("batch_id") == COMPACTED))
    return meas.join(landed.select("id"), "id", "left_anti")


def process_batch(messages: DataFrame, sensors: DataFrame, out_root: str, batch_id: int,
                  ingest_time: Column | None = None, alerts: bool = True,
                  after_sink: Callable[[str, int], None] | None = None) -> None:
    """Parse, flag and land one batch into the sinks: measurements, raw archive
    (every message), quarantine, and one alert row.

    The batch is decoded and flagged once and written below ``_staging`` of the
    output folder, so each sink reads columns of a table that a lost executor
    does not take along; it is deleted when the sinks are written. ``after_sink``
    is called with each sink's name and the batch id once it is written.
    """
    root = out_root.rstrip("/")
    spark = messages.sparkSession
    done = after_sink or (lambda sink, batch: None)
    at = f"{root}/_staging/{batch_id}-{uuid.uuid4().hex[:12]}"
    flagged = flag_batch(parse_batch(messages, ingest_time), sensors).withColumn("_part", F.spark_partition_id())
    try:
        flagged.write.parquet(at)
        batch = spark.read.schema(flagged.schema).parquet(at)
        repeated, dates = survey(batch)
        if repeated:
            batch = number_copies(batch)
        # Measurements and quarantine first: these writes make every message
        # queryable. The order does not weaken the archive: a failed batch is
        # replayed whole and every sink overwrites its own batch partition.
        meas, quar = split_batch(batch)
        write_measurements(not_compacted(meas, f"{root}/measurements", dates), f"{root}/measurements", batch_id)
        done("measurements", batch_id)
        (quar.withColumn("batch_id", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(f"{root}/quarantine"))
        done("quarantine", batch_id)
        write_raw(batch, f"{root}/raw", F.col("created_at"), batch_id)
        done("raw", batch_id)
        if alerts:
            (batch_alerts(batch, batch_id)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(f"{root}/alerts"))
            done("alerts", batch_id)
    finally:
        delete(spark, at)


def _drop_leftovers(spark: SparkSession, out_root: str) -> None:
    """Delete what a lost driver's batches left staged; one ingest writes to an output folder at a time."""
    fs, p = hadoop_path(spark, f"{out_root.rstrip('/')}/_staging")
    if fs.exists(p):
        for f in fs.listStatus(p):
            if f.getPath().getName()[0].isdigit():  # a batch of the stream; replays have a name
                fs.delete(f.getPath(), True)


def refreshing(load: Callable[[], DataFrame], ttl_seconds: float = 60.0,
               clock: Callable[[], float] | None = None) -> Callable[[], DataFrame]:
    """Wrap a dimension loader for ``start_ingest``: the table is read and kept
    (memory, spilling to disk) for ``ttl_seconds``, then re-read, so updates
    show up within the TTL without re-reading the table on every micro-batch."""
    import time

    now = clock or time.monotonic
    state: dict = {}

    def get() -> DataFrame:
        t = now()
        if "df" not in state or t - state["at"] >= ttl_seconds:
            old = state.get("df")
            state["df"] = load().persist(StorageLevel.MEMORY_AND_DISK)
            state["at"] = t
            if old is not None:
                old.unpersist()
        return state["df"]

    return get


def replay_quarantine(spark: SparkSession, out_root: str, sensors: DataFrame, batch_id: int) -> int:
    """Re-land quarantined readings of sensors the dimension now knows.

    Rows quarantined as ``unknown_sensor`` are parsed again and routed: those
    whose sensor exists now are written to the fact table as batch ``batch_id``
    (an idempotent batch like any other) under the ids they had. The quarantine
    keeps its rows as a record; readings that another batch of the fact table
    holds are not landed again, so a second replay adds none. Returns the number
    landed.

    The lookup opens only the dates of the readings to land and, in them, ids of
    their sensors; the table has no rows of a sensor that is new to the
    dimension, so few rows are compared.
    """
    root = out_root.rstrip("/")
    q = spark.read.parquet(f"{root}/quarantine").filter(F.col("error_class") == S.FLAG_UNKNOWN)
    known = dim_join(q, sensors.select("sensor_id"), "sensor_id", "left_semi")  # parse only what may land
    msgs = known.select(F.col("id").alias("msg_id"), "body", F.col("quarantined_at").alias("arrival_time"))
    at = f"{root}/_staging/replay-{batch_id}-{uuid.uuid4().hex[:12]}"
    try:
        readings_from_messages(msgs, sensors)[0].write.parquet(at)
        meas = spark.read.parquet(at)
        meas = unlanded(meas, f"{root}/measurements", batch_id)
        write_measurements(meas, f"{root}/measurements", batch_id)
        return spark.read.parquet(f"{root}/measurements").filter(F.col("batch_id") == batch_id).count()
    finally:
        delete(spark, at)


def unlanded(meas: DataFrame, facts_path: str, batch_id: int) -> DataFrame:
    """Readings whose id no other batch of the fact table holds; opens the dates and sensors of ``meas`` only."""
    spark = meas.sparkSession
    dates = [r[0] for r in meas.select(F.to_date("timestamp")).distinct().collect()]  # a row per date
    facts = spark.read.parquet(facts_path).filter(F.col("event_date").isin(dates) & (F.col("batch_id") != batch_id))
    theirs = dim_join(facts.select("sensor_id", "id"), meas.select("sensor_id").distinct(), "sensor_id", "left_semi")
    return meas.join(theirs, ["sensor_id", "id"], "left_anti")


def start_ingest(spark: SparkSession, landing: str, out_root: str, checkpoint: str,
                 sensors: Callable[[], DataFrame], trigger: dict | None = None,
                 max_files_per_trigger: int | None = None, query_name: str | None = None,
                 max_bytes_per_trigger: int | str | None = None, archive_read_files: str | None = None,
                 after_sink: Callable[[str, int], None] | None = None):
    """Continuous ingest (T1): one streaming query whose micro-batches fan out to
    raw / measurements / quarantine / alerts.

    ``sensors`` is called per batch so dimension updates become visible. A batch
    is flushed by time or by size (S8, T2): ``trigger`` defaults to
    ``processingTime='5 seconds'`` (the flush interval), and a batch takes at most
    ``max_bytes_per_trigger`` of landed bytes (whole files; one file at least) or
    ``max_files_per_trigger`` files, so that a backlog is worked off in batches of
    bounded size. ``archive_read_files`` names a folder that finished landing files
    move to, so that listing the landing folder does not grow with its history.
    Tests use ``{'availableNow': True}``.
    """
    _drop_leftovers(spark, out_root)
    msgs = read_messages(spark, landing, streaming=True, max_files_per_trigger=max_files_per_trigger,
                         max_bytes_per_trigger=max_bytes_per_trigger, archive_read_files=archive_read_files,
                         spread=SPREAD * spark.sparkContext.defaultParallelism)

    def _batch(df: DataFrame, batch_id: int) -> None:
        process_batch(df, sensors(), out_root, batch_id, after_sink=after_sink)

    w = msgs.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": "5 seconds"}))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def run_batch_ingest(spark: SparkSession, landing: str, out_root: str, sensors: DataFrame,
                     batch_id: int = 0, ingest_time: Column | None = None) -> None:
    """The same plan as one batch job over a landing folder (or a raw-archive replay, S16)."""
    process_batch(read_messages(spark, landing), sensors, out_root, batch_id, ingest_time)


__all__ = ["parse_batch", "flag_batch", "split_batch", "route", "survey", "number_copies", "not_compacted", "unlanded", "readings_from_messages", "process_batch", "start_ingest",
           "run_batch_ingest", "refreshing", "replay_quarantine"]
