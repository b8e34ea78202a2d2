"""Files of a Parquet folder: listing, and replacing files so that a lost driver loses nothing.

``replace_files`` first writes the new files completely below ``_rewrite`` (readers skip names with an underscore),
then the list of the files they stand for; only then are new files moved into place and old ones deleted.
``finish_rewrites`` carries out what a lost driver left: a rewrite whose list is complete is finished, another one is
dropped, and the table is as before. Each step can be repeated. One maintenance job may run on a table at a time;
writers of other partitions may go on.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REWRITES = "_rewrite"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path string."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders (``column=value``) directly below ``path``."""
    fs, p = hadoop_path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory() and "=" in f.getPath().getName())


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The partition columns of a Parquet folder, outermost first, read off its folder names."""
    out, at = [], path.rstrip("/")
    while names := folders(spark, at):
        out.append(names[0].split("=", 1)[0])
        at = f"{at}/{names[0]}"
    return out


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """``path, length`` of every file below ``path``, listed by Spark; no file is opened."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern) \
        .load(path).select("path", "length")


def partition_value(name: str):
    """The value of a partition level in the ``path`` column of ``list_files``, as text; NULL where it is the null partition."""
    value = F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    return F.when(~value.isin("", "__HIVE_DEFAULT_PARTITION__"), value)


def replace_files(spark: SparkSession, path: str, new: DataFrame, old: list[str], parts: list[str], sort_within=()) -> None:
    """Put the rows of ``new``, partitioned by ``parts``, in the place of the files ``old`` of the folder ``path``."""
    root = path.rstrip("/")
    run = f"{root}/{REWRITES}/{uuid.uuid4().hex}"
    keys = parts + [c for c in sort_within if c in new.columns and c not in parts]
    new.hint("rebalance", *parts).sortWithinPartitions(*keys).write.partitionBy(*parts).parquet(f"{run}/new")
    spark.createDataFrame([(f,) for f in old], "value string").write.text(f"{run}/old")  # from here on the rewrite counts
    _finish(spark, root, run)


def finish_rewrites(spark: SparkSession, path: str) -> None:
    """Finish or drop what an interrupted rewrite of this folder left."""
    root = path.rstrip("/")
    if not exists(spark, f"{root}/{REWRITES}"):
        return
    fs, p = hadoop_path(spark, f"{root}/{REWRITES}")
    for f in fs.listStatus(p):
        run = f"{root}/{REWRITES}/{f.getPath().getName()}"
        if exists(spark, f"{run}/old/_SUCCESS"):
            _finish(spark, root, run)
        else:
            delete(spark, run)


def _finish(spark: SparkSession, root: str, run: str) -> None:
    fs, base = hadoop_path(spark, f"{run}/new")
    base = fs.makeQualified(base).toString() + "/"
    found = fs.listFiles(hadoop_path(spark, f"{run}/new")[1], True)
    while found.hasNext():
        at = found.next().getPath()
        inside = at.toString()[len(base):]
        if inside.endswith(".parquet"):
            to = hadoop_path(spark, f"{root}/{inside}")[1]
            fs.mkdirs(to.getParent())
            fs.rename(at, to)
    for row in spark.read.text(f"{run}/old").toLocalIterator():
        _, old = hadoop_path(spark, row["value"])
        fs.delete(old, False)
        if fs.exists(old.getParent()) and not fs.listStatus(old.getParent()):
            fs.delete(old.getParent(), False)
    fs.delete(hadoop_path(spark, run)[1], True)


__all__ = ["hadoop_path", "exists", "delete", "folders", "partition_columns", "list_files", "partition_value", "replace_files",
           "finish_rewrites"]
