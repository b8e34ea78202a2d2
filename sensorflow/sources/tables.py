"""Table maintenance on date-partitioned Parquet folders: retention, compaction, size statistics.

Retention deletes expired dates as folders and rewrites only partitions that the cut runs through; compaction folds
the small files of closed dates, of all batches that landed rows in them, into few. Both write new files completely
before an old one goes (``sources.files``), so a lost executor only repeats its tasks and a lost driver's work is
finished by the next run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.text import pretty_size
from sensorflow.functions.time import as_of_value, before, parse_interval, ts_lit
from sensorflow.sources.files import (delete, finish_rewrites, folders, hadoop_path, list_files, partition_columns, partition_value,
                                      replace_files)

#: Fixed value: the batch that compacted rows belong to; batches of a stream count from 0.
COMPACTED = -1


def apply_retention(m: DataFrame, as_of: dt.datetime, keep="90 days", col: str = "timestamp",
                    date_col: str = "event_date") -> DataFrame:
    """Rows that survive ``DELETE .. WHERE col < as_of - keep`` (S12).

    Date partitions entirely before the cut are pruned without being read; only
    the boundary date is filtered row by row.
    """
    cut = as_of_value(as_of) - parse_interval(keep)
    out = m
    if date_col in m.columns:
        out = out.filter(F.col(date_col) >= F.lit(cut.date()))
    return out.filter(F.col(col) >= ts_lit(cut))


def expired_rows(m: DataFrame, as_of: dt.datetime, keep="90 days", col: str = "timestamp") -> DataFrame:
    """The rows a retention run removes (for audit)."""
    return before(m, as_of, keep, col)


def drop_expired(spark: SparkSession, path: str, as_of: dt.datetime, keep="90 days", col: str = "timestamp",
                 date_col: str = "event_date", sort_within=("sensor_id", "timestamp")) -> int:
    """Q18's ``DELETE .. WHERE col < as_of - keep`` on a table partitioned by the date of ``col``.

    Dates before the cut go as folders, unread. Of the boundary date only the
    partitions holding expired rows are touched: deleted if nothing in them
    survives, else rewritten. Files of all later dates stay as they are. Rows
    without a date (NULL ``col``) stay, as in SQL. Returns the number of
    partitions deleted or rewritten.
    """
    root = path.rstrip("/")
    finish_rewrites(spark, root)
    cut = as_of_value(as_of) - parse_interval(keep)
    dates = {n: n.split("=", 1)[1] for n in folders(spark, root) if n.startswith(f"{date_col}=")}
    old = [n for n, d in dates.items() if d != "__HIVE_DEFAULT_PARTITION__" and dt.date.fromisoformat(d) < cut.date()]
    for name in old:
        delete(spark, f"{root}/{name}")
    if f"{date_col}={cut.date()}" not in dates:
        return len(old)
    parts = partition_columns(spark, root)
    day = spark.read.parquet(root).filter(F.col(date_col) == F.lit(cut.date()))
    gone = F.col(col) < ts_lit(cut)
    # one row per file below one date
    hit = day.groupBy(*parts, F.col("_metadata.file_path").alias("_f")).agg(F.count_if(gone).alias("_gone")).filter("_gone > 0")
    hit = [r.asDict() for r in hit.collect()]
    if hit:
        files = [r["_f"] for r in hit]
        replace_files(spark, root, spark.read.option("basePath", root).schema(day.schema).parquet(*files).filter(~gone), files, parts, sort_within)
    return len(old) + len({tuple(r[c] for c in parts) for r in hit})


def compact_table(spark: SparkSession, path: str, before_date: dt.date | str | None = None, target_bytes: int = 256 << 20,
                  date_col: str = "event_date", batch_col: str = "batch_id", sort_within=("sensor_id", "timestamp")) -> list[str]:
    """S13: fold the files of closed dates, those before ``before_date`` (all by default), where that makes them fewer.

    The files of a date are listed, not opened; a date is rewritten if it has more files than its bytes need at
    ``target_bytes`` a file. Where the table has a ``batch_col`` level, as the ingest writes it, the rows of all its
    batches move to one folder, batch ``COMPACTED``; a batch that is replayed later finds its readings there by their
    ids. Rows are rebalanced on the partition columns, so a partition becomes one file, or several where adaptive
    execution splits a big one, in (sensor, time) order. Dates without a rewrite keep their files. A batch that lands
    rows meanwhile keeps its own files. Returns the dates rewritten.
    """
    root = path.rstrip("/")
    finish_rewrites(spark, root)
    parts = partition_columns(spark, root)
    level = [c for c in parts if c != batch_col]  # what the rows of one folder share after compaction
    files = list_files(spark, root).withColumns({"_d": partition_value(date_col), "_p": F.concat_ws(
        "/", *[F.regexp_extract("path", f"/{c}=([^/]+)/", 1) for c in level])})
    if before_date is not None:
        files = files.filter(F.col("_d") < F.lit(str(before_date)))
    need = F.greatest(F.lit(1), F.ceil(F.sum("length") / F.lit(target_bytes)))
    crowded = files.groupBy("_d", "_p").agg(F.count(F.lit(1)).alias("_n"), need.alias("_need")).filter("_n > _need")
    dates = sorted(r[0] for r in crowded.filter("_d is not null").select("_d").distinct().collect())
    if dates:
        # the files as this read lists them: what a batch lands from now on is neither read nor replaced
        rows = spark.read.option("basePath", root).schema(spark.read.parquet(root).schema).parquet(*[f"{root}/{date_col}={d}" for d in dates])
        old = rows.inputFiles()
        if batch_col in parts:
            rows = rows.withColumn(batch_col, F.lit(COMPACTED).cast(rows.schema[batch_col].dataType))
        replace_files(spark, root, rows, old, parts, sort_within)
    return dates


def table_stats(spark: SparkSession, path: str, name: str, by: str | None = None) -> DataFrame:
    """Row count and on-disk size of a Parquet table (S14), or of each value of its partition column ``by``.

    Sizes come from listing the files, rows from their footers (COUNT pushed down
    into the Parquet scan), so no data is read. Index size has no meaning for
    files and stays NULL.
    """
    fs, p = hadoop_path(spark, path)
    table = spark.read.parquet(path)
    files = list_files(spark, path if fs.getFileStatus(p).isDirectory() else path.rsplit("/", 1)[0],
                       "*.parquet" if fs.getFileStatus(p).isDirectory() else path.rsplit("/", 1)[1])
    if by is None:
        # two one-row aggregates
        rows = table.agg(F.count(F.lit(1)).alias("row_count"))
        both = rows.join(F.broadcast(files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))))
        keys = []
    else:
        # no column is read for a count by partition
        rows = table.groupBy(F.col(by).cast("string").alias(by)).agg(F.count(F.lit(1)).alias("row_count"))
        sizes = files.groupBy(partition_value(by).alias("_by")).agg(F.sum("length").alias("bytes"))
        both = rows.join(sizes, F.col(by).eqNullSafe(F.col("_by")), "full").withColumns({
            by: F.coalesce(by, "_by"), "row_count": F.coalesce("row_count", F.lit(0)), "bytes": F.coalesce("bytes", F.lit(0))})
        keys = [by]
    return both.select(F.lit(name).alias("table_name"), *keys, "row_count", pretty_size("bytes").alias("total_size"),
                       pretty_size("bytes").alias("table_size"), F.lit(None).cast("string").alias("indexes_size"))


__all__ = ["apply_retention", "drop_expired", "expired_rows", "compact_table", "partition_columns", "table_stats", "COMPACTED"]
