"""Sinks: raw archive, fact table, rollups, CSV export, wide rows.

Writes are idempotent per batch: the fact table is partitioned by
``event_date`` and ``batch_id`` and written with dynamic partition overwrite,
so replaying batch N after a failure replaces exactly what batch N wrote.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.time import since
from sensorflow.operators.joins import dim_join

# Raw archive file naming is by arrival day (yyyyMMdd).
RAW_DATE_FORMAT = "yyyyMMdd"


def raw_envelope(messages: DataFrame, arrival: Column) -> DataFrame:
    """{topic, timestamp (arrival, ISO), id, payload} lines plus the arrival day.

    The body is stored once and verbatim: as the line's ``payload`` where it is
    JSON on one line, so that it reads as a value and as the original bytes, else
    as the text ``payload_text``. The message's id stands beside it, so a replay
    lands under the original id.
    """
    ids = [F.col(c).cast("long") for c in ("id", "msg_id") if c in messages.columns]
    d = messages.select("*", F.inline(F.array(F.struct(
        F.try_parse_json("body").isNotNull().alias("_json"), F.date_format(arrival, RAW_DATE_FORMAT).alias("_day")))))
    head = F.concat(F.lit('{"topic":'), F.coalesce(_quoted(F.col("topic")), F.lit("null")), F.lit(',"timestamp":'),
                    F.coalesce(_quoted(F.date_format(arrival, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), F.lit("null")),
                    F.coalesce(F.concat(F.lit(',"id":'), F.coalesce(*ids).cast("string")), F.lit("")) if ids else F.lit(""))
    inline = F.col("_json") & ~F.col("body").rlike("[\r\n]")
    body = F.when(inline, F.concat(F.lit(',"payload":'), F.col("body"))) \
        .otherwise(F.coalesce(F.concat(F.lit(',"payload_text":'), _quoted(F.col("body"))), F.lit("")))
    return d.select(F.concat(head, body, F.lit("}")).alias("value"), F.col("_day").alias("ingest_date"))


def _quoted(text: Column) -> Column:
    """The text as a JSON string; NULL for NULL."""
    inside = F.to_json(F.struct(text.alias("s")))  # {"s":"..."}
    return F.when(text.isNotNull(), F.substring(inside, 6, F.length(inside) - 6))


def write_raw(messages: DataFrame, path: str, arrival: Column, batch_id: int | None = None,
              rebalance: bool = True) -> None:
    """Archive every message, valid or not, as JSON lines per arrival day (S6).

    ``rebalance`` groups rows by day before writing (AQE merges small days and
    splits a hot one), so a batch spanning many days writes a few files per
    day instead of one per task and day.
    """
    out = raw_envelope(messages, arrival)
    parts = ["ingest_date"]
    if batch_id is not None:
        out = out.withColumn("batch_id", F.lit(batch_id))
        parts.append("batch_id")
    if rebalance:
        out = out.hint("rebalance", "ingest_date")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts).text(path))


def write_measurements(m: DataFrame, path: str, batch_id: int | None = None,
                       sort_within=("sensor_id", "timestamp"), by_sensor: bool = False,
                       rebalance: bool = True, by_ingest_date: bool = False) -> None:
    """Append a batch of readings to the fact table, partitioned by event date (S7, S17).

    Rows are sorted by (sensor_id, timestamp) inside files so Parquet min/max
    statistics skip row groups for sensor and time predicates. ``by_sensor``
    adds a sensor partition level, worthwhile only for small fleets (each
    sensor and day becomes a folder). ``rebalance`` groups rows by date before
    the write (one shuffle; AQE merges small dates and splits a hot one into
    several tasks), so late or replayed data spanning many dates lands as a few
    files per date rather than one per task and date. ``by_ingest_date`` adds a
    level for the day of ``created_at``, by which lookbacks over landing time are
    pruned; use it where a retried batch keeps its landing times.
    """
    out = m.withColumn("event_date", F.to_date(F.col("timestamp")))
    parts = ["event_date"] + (["sensor_id"] if by_sensor else [])
    if by_ingest_date:
        out = out.withColumn("ingest_date", F.to_date(F.col("created_at")))
        parts.append("ingest_date")
    if batch_id is not None:
        out = out.withColumn("batch_id", F.lit(batch_id).cast("long"))
        parts.append("batch_id")
    if rebalance:
        out = out.hint("rebalance", "event_date")
    out = out.sortWithinPartitions(*parts, *[c for c in sort_within if c not in parts])
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts).parquet(path))


def write_rollup(r: DataFrame, path: str) -> None:
    """Persist a resampled rollup by day (S18), rebalanced by day before writing."""
    (r.withColumn("event_date", F.to_date("timestamp")).hint("rebalance", "event_date")
      .sortWithinPartitions("event_date", "sensor_id", "timestamp")
      .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
      .partitionBy("event_date").parquet(path))


def write_data_quality(dq: DataFrame, path: str) -> None:
    """Persist quality indicators in the ``data_quality`` shape, by check date;
    re-running a check for a date replaces that date."""
    (dq.withColumn("check_date", F.to_date("check_timestamp"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("check_date").parquet(path))


def to_wide_measurements(messages: DataFrame, keep=()) -> DataFrame:
    """Denormalised rows of the second ingest path (S9): sensor_id, type, value
    (float32), unit, location (text, objects as JSON), timestamp from epoch seconds."""
    v = F.try_parse_json(F.col("body"))

    def txt(f):
        t = F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant"))
        return F.when(t == "STRING", F.try_variant_get(v, f"$.{f}", "string")).otherwise(
            F.to_json(F.try_variant_get(v, f"$.{f}", "variant")))

    return messages.select(
        *keep,
        txt("sensor_id").alias("sensor_id"),
        txt("type").alias("type"),
        F.try_variant_get(v, "$.value", "double").cast("float").alias("value"),
        txt("unit").alias("unit"),
        txt("location").alias("location"),
        F.timestamp_seconds(F.try_variant_get(v, "$.timestamp", "double")).cast("timestamp_ntz").alias("timestamp"),
    )


EXPORT_COLUMNS = ["sensor_id", "location", "sensor_type", "timestamp", "value", "unit", "quality_flag"]


def export_frame(m: DataFrame, sensors: DataFrame, as_of: dt.datetime | None = None,
                 lookback="1 hour") -> DataFrame:
    """Readings of the lookback joined with their sensor, ordered by (timestamp, sensor_id)."""
    f = since(m, as_of, lookback)
    j = dim_join(f, sensors.select("sensor_id", "location", "sensor_type", "unit"), "sensor_id", "inner")
    return j.select(*EXPORT_COLUMNS, "id").orderBy("timestamp", "sensor_id", "id").drop("id")


def export_csv(m: DataFrame, sensors: DataFrame, path: str, as_of: dt.datetime | None = None,
               lookback="1 hour", single_file: bool = False) -> None:
    """CSV with header (S11). The global sort is a range-partitioned shuffle;
    ``single_file`` coalesces the sorted result for small exports only."""
    out = export_frame(m, sensors, as_of, lookback)
    if single_file:
        out = out.coalesce(1)
    (out.write.mode("overwrite").option("header", True).option("nullValue", "")
        .option("emptyValue", "\"\"").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path))


__all__ = ["raw_envelope", "write_raw", "write_measurements", "write_rollup", "write_data_quality", "to_wide_measurements",
           "export_frame", "export_csv", "EXPORT_COLUMNS"]
