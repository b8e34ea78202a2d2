"""Streaming rollups and duplicate removal (T5, T6).

``start_rollup`` keeps no event-time state: each micro-batch appends mergeable
partial aggregates (sum, counts, min, max) of the windows it touches, in folders
of their event date and batch, and ``read_rollup`` merges them. Late readings
count however late they are, and the newest window is there at once. Partials of
finished batches are folded as the stream goes, so a date is held in few files
however many batches touched it. ``close_rollup`` folds closed dates for good and
carries their states on to hours and from hours to days, each level computed from
the one below; readings that come later still are merged with them on read.

``start_dedupe`` removes repeats against what has landed, however late they are;
``dedupe_stream`` is its watermarked form, with state bounded by a delay.

``rollup_stream`` is the watermarked form for sinks that need each window once:
a window is emitted when the watermark passes its end, and readings later than
``delay`` are left out of it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.functions.time import trunc_ntz
from sensorflow.sources.files import delete, exists, finish_rewrites, folders, list_files, partition_value, replace_files
from sensorflow.sources.tables import COMPACTED

#: Fixed value: the batch of partials whose date is closed (``COMPACTED``: folded, but of an open date).
CLOSED = COMPACTED - 1
#: Levels of the rollup above the stream's own windows, each from the one before.
LEVELS = ("hour", "day")


def rollup_stream(readings: DataFrame, every: str = "1 minute", delay: str = "10 minutes",
                  quality: str | None = None) -> DataFrame:
    """Streaming tumbling-window rollup with the batch ``resample`` output shape."""
    f = readings if quality is None else readings.filter(F.col("quality_flag") == quality)
    # Watermarks need a zoned TIMESTAMP; the session zone is UTC, so the cast
    # there and back keeps the wall clock.
    f = f.withColumn("_et", F.col("timestamp").cast("timestamp"))
    return (f.withWatermark("_et", delay)
             .groupBy("sensor_id", F.window("_et", every))
             .agg(F.avg("value").alias("avg_value"), F.min("value").alias("min_value"),
                  F.max("value").alias("max_value"), F.count(F.lit(1)).alias("sample_count"))
             .select("sensor_id", F.col("window.start").cast("timestamp_ntz").alias("timestamp"), "avg_value",
                     "min_value", "max_value", "sample_count"))


def dedupe_stream(readings: DataFrame, keys=("sensor_id", "timestamp"), delay: str = "10 minutes") -> DataFrame:
    """Drop repeated (sensor_id, timestamp) readings arriving within ``delay`` of each other.

    Readings later than the watermark are dropped, as in any watermarked operator;
    where they must land use ``start_dedupe``.
    """
    ev = readings.withColumn("_et", F.col("timestamp").cast("timestamp"))
    return ev.withWatermark("_et", delay).dropDuplicatesWithinWatermark(list(keys)).drop("_et")


def error_rate_stream(parsed: DataFrame, window: str = "1 hour", delay: str = "10 minutes",
                      time_col: str = "arrival_time", limit: float = 0.01) -> DataFrame:
    """Streaming form of the error-rate alert (T7, M2): rejected share of the
    messages per arrival window, emitted once the window closes."""
    ev = parsed.withColumn("_et", F.col(time_col).cast("timestamp"))
    g = (ev.withWatermark("_et", delay)
           .groupBy(F.window("_et", window))
           .agg(F.count(F.lit(1)).alias("messages"),
                F.count_if(F.col("error_class").isNotNull()).alias("errors")))
    rate = F.try_divide(F.col("errors").cast("double"), F.col("messages").cast("double"))
    return g.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "messages", "errors",
                    rate.alias("error_rate"), (rate > F.lit(limit)).alias("alert"))


def start_error_rate(parsed: DataFrame, path: str, checkpoint: str, window: str = "1 hour", delay: str = "10 minutes",
                     time_col: str = "arrival_time", limit: float = 0.01, trigger: dict | None = None):
    """Keep the error rate of arrival windows as a live alert table (T7, M2).

    A window's counts wait in the stream's state, across micro-batches and
    restarts, until the watermark passes its end; then its row is appended to the
    Parquet folder, once. State holds a row per open window. Messages without a
    ``time_col`` count in no window.
    """
    return (error_rate_stream(parsed, window, delay, time_col, limit).writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start())


STATE = ["value_sum", "value_count", "min_value", "max_value", "sample_count"]


def window_partials(readings: DataFrame, every: str = "1 minute") -> DataFrame:
    """Mergeable aggregates per (sensor, window) of a batch of readings."""
    return (readings.groupBy("sensor_id", F.window(F.col("timestamp").cast("timestamp"), every))
            .agg(F.sum("value").alias("value_sum"), F.count("value").alias("value_count"), F.min("value").alias("min_value"),
                 F.max("value").alias("max_value"), F.count(F.lit(1)).alias("sample_count"))
            .select("sensor_id", F.col("window.start").cast("timestamp_ntz").alias("timestamp"), *STATE))


def coarsened(partials: DataFrame, unit: str | None = None) -> DataFrame:
    """Partials merged per sensor and window, or per sensor and ``unit`` (hour, day) of their windows."""
    at = F.col("timestamp") if unit is None else trunc_ntz(unit, "timestamp")
    return partials.groupBy("sensor_id", at.alias("timestamp")).agg(
        F.sum("value_sum").alias("value_sum"), F.sum("value_count").alias("value_count"), F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"), F.sum("sample_count").alias("sample_count"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """The rollup (batch ``resample`` shape) of any number of partial aggregates."""
    return coarsened(partials).select("sensor_id", "timestamp", F.try_divide("value_sum", "value_count").alias("avg_value"),
                                      "min_value", "max_value", "sample_count")


def _dated(partials: DataFrame, batch_id: int) -> DataFrame:
    return partials.withColumns({"event_date": F.to_date("timestamp"), "batch_id": F.lit(batch_id).cast("long")})


def _level(spark, path: str, level: str) -> DataFrame:
    schema = "sensor_id string, timestamp timestamp_ntz, value_sum double, value_count long, min_value double, max_value double, " \
             "sample_count long, event_date date" + (", batch_id long" if level == "window" else "")
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{level}")


def _closed_dates(spark, path: str, level: str) -> list[dt.date]:
    at = f"{path.rstrip('/')}/{level}"
    return [dt.date.fromisoformat(n.split("=", 1)[1]) for n in folders(spark, at)] if exists(spark, at) else []


def read_rollup(spark, path: str, unit: str | None = None, dates=None) -> DataFrame:
    """The rollup by the stream's own windows, or by ``unit`` 'hour' or 'day'; of ``dates`` (datetime.date) only, if given.

    Only folders of those dates are opened. For a coarser unit a closed date is
    read from that level's own states; partials that landed after it was closed,
    and open dates, are merged from the windows.
    """
    partials = _level(spark, path, "window")
    chosen = F.lit(True) if dates is None else F.col("event_date").isin(list(dates))
    partials = partials.filter(chosen)
    if unit is None:
        return merge_partials(partials)
    closed = _closed_dates(spark, path, unit)
    states = coarsened(partials.filter((F.col("batch_id") != CLOSED) | ~F.col("event_date").isin(closed)), unit)
    if closed:
        states = states.unionByName(_level(spark, path, unit).filter(chosen).select("sensor_id", "timestamp", *STATE))
    return merge_partials(states)


def fold_partials(spark, path: str, before_batch: int) -> list[str]:
    """Merge the partials of batches below ``before_batch`` into one folder per open date; returns the dates folded.

    Those batches are committed, so none of them is replayed. Partials of closed
    dates stay as they are; what came later for them is folded beside them.
    """
    root = f"{path.rstrip('/')}/window"
    finish_rewrites(spark, root)
    batch = partition_value("batch_id").cast("long")
    found = list_files(spark, root).select(partition_value("event_date").alias("d"), batch.alias("b")) \
        .filter((F.col("b") < before_batch) & (F.col("b") >= COMPACTED))
    many = found.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.collect_set("b").alias("b")).filter("n > 1").collect()
    if many:
        _rewrite(spark, root, [f"event_date={r['d']}/batch_id={b}" for r in many for b in r["b"]], COMPACTED)
    return sorted(r["d"] for r in many)


def _rewrite(spark, root: str, inside: list[str], batch_id: int) -> None:
    rows = spark.read.option("basePath", root).schema(spark.read.parquet(root).schema).parquet(*[f"{root}/{f}" for f in inside])
    replace_files(spark, root, _dated(coarsened(rows), batch_id), rows.inputFiles(), ["event_date", "batch_id"], ["sensor_id", "timestamp"])


def close_rollup(spark, path: str, before_date: dt.date) -> list[str]:
    """Fold the dates before ``before_date`` for good and store their hours and days; returns the dates closed now.

    A date that was closed before and has partials of later batches is closed
    again. The coarser states of a date are deleted before its windows are
    rewritten and written from these afterwards, so a reader always merges each
    partial once, and a run that is lost is made good by the next.
    """
    path = path.rstrip("/")
    root = f"{path}/window"
    finish_rewrites(spark, root)
    found = list_files(spark, root).select(partition_value("event_date").alias("d"), partition_value("batch_id").cast("long").alias("b")) \
        .filter(F.col("d") < F.lit(str(before_date)))
    todo = found.groupBy("d").agg(F.collect_set("b").alias("b")).filter(F.size(F.filter("b", lambda b: b != CLOSED)) > 0).collect()
    for r in todo:
        for level in LEVELS:
            delete(spark, f"{path}/{level}/event_date={r['d']}")
    if todo:
        _rewrite(spark, root, [f"event_date={r['d']}/batch_id={b}" for r in todo for b in r["b"]], CLOSED)
    below, source = "window", _level(spark, path, "window").filter(F.col("batch_id") == CLOSED)
    for level in LEVELS:
        dates = set(_closed_dates(spark, path, below)) - set(_closed_dates(spark, path, level))
        dates = [d for d in dates if d < before_date]
        if dates:
            (coarsened(source.filter(F.col("event_date").isin(dates)), level).withColumn("event_date", F.to_date("timestamp"))
             .hint("rebalance", "event_date").sortWithinPartitions("event_date", "sensor_id", "timestamp")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(f"{path}/{level}"))
        below = level
        if exists(spark, f"{path}/{level}"):
            source = _level(spark, path, level)
    return sorted(r["d"] for r in todo)


def _land_partials(batch: DataFrame, path: str, batch_id: int, every: str) -> None:
    (_dated(window_partials(batch, every), batch_id).hint("rebalance", "event_date").sortWithinPartitions("event_date", "sensor_id", "timestamp")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").parquet(f"{path.rstrip('/')}/window"))


def start_rollup(readings: DataFrame, path: str, checkpoint: str, every: str = "1 minute", trigger: dict | None = None,
                 fold_every: int = 64):
    """Append each micro-batch's partials to a Parquet folder, by event date and batch.

    A batch replayed after a failure replaces its own ``batch_id`` partitions, so
    every reading counts exactly once. Every ``fold_every`` batches the partials
    of the batches before are folded, so a date holds at most about that many
    files. Windows must not span dates (they divide a day) for the states of days.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        _land_partials(batch, path, batch_id, every)
        if batch_id and batch_id % fold_every == 0:
            fold_partials(batch.sparkSession, path, batch_id)

    return (readings.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def start_dedupe(readings: DataFrame, path: str, checkpoint: str, keys=("sensor_id", "timestamp"), trigger: dict | None = None):
    """Land each (sensor_id, timestamp) reading once, in date-partitioned Parquet, without a watermark.

    A micro-batch keeps one row per key (the smallest by all its columns) and leaves out keys
    that earlier batches landed, looked up in the batch's dates only. Late readings land too.
    A batch replayed after a failure replaces its own partitions.
    """
    keys = list(keys)

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c not in keys]
        new = batch.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, *[F.col(f"_r.{c}") for c in rest]) \
            if rest else batch.dropDuplicates(keys)
        new = new.withColumn("event_date", F.to_date("timestamp"))
        if batch_id > 0:
            landed = T.StructType([*batch.select(*keys).schema.fields, T.StructField("event_date", T.DateType()),
                                   T.StructField("batch_id", T.LongType())])
            dates = [r[0] for r in batch.select(F.to_date("timestamp")).distinct().collect() if r[0] is not None]
            seen = spark.read.schema(landed).parquet(path) \
                .filter(F.col("event_date").isin(dates) & (F.col("batch_id") < batch_id))
            new = new.join(seen.select(*keys), keys, "left_anti")
        (new.withColumn("batch_id", F.lit(batch_id).cast("long")).hint("rebalance", "event_date")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").parquet(path))

    return (readings.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def start_rollup_from_table(spark, table_path: str, path: str, checkpoint: str, every: str = "1 minute",
                            trigger: dict | None = None, max_files_per_trigger: int | None = None):
    """Maintain the rollup from the fact table itself: the Parquet folder the
    ingest writes is read as a file stream, so the rollup trails the facts.

    Compacted files hold readings the stream has seen in their batches' files, so
    the stream leaves them out; when it starts for the first time, what was
    compacted by then is taken in by one batch job.
    """
    schema = spark.read.parquet(table_path).schema
    batched = "batch_id" in schema.fieldNames()
    if batched and not exists(spark, checkpoint):
        old = spark.read.parquet(table_path).filter(F.col("batch_id") == COMPACTED)
        _land_partials(old.select("sensor_id", "timestamp", "value"), path, COMPACTED, every)
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    readings = r.load(table_path)
    if batched:
        readings = readings.filter(F.col("batch_id") != COMPACTED)
    return start_rollup(readings.select("sensor_id", "timestamp", "value"), path, checkpoint, every, trigger)


__all__ = ["rollup_stream", "window_partials", "coarsened", "merge_partials", "read_rollup", "fold_partials", "close_rollup", "dedupe_stream",
           "start_dedupe", "error_rate_stream", "start_error_rate", "start_rollup", "start_rollup_from_table"]
