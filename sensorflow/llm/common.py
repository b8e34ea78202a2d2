"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorflow.session import scratch_dir
from sensorflow.sources.files import delete

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Word bytes of a lower-cased text: digits, a-z and everything outside ASCII; the rest becomes a space.
WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
                   for c in range(256))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def col(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that no extra column can clash."""
    return df.select(*[col(source).alias(name) for name, source in columns.items()])


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Names like ``bases`` that no column of ``df`` has (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name = base
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


#: Folders of the tables that ``staged`` wrote, for ``release``.
WRITTEN: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later jobs see the same rows whatever executors are lost."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_in_turn(parts: list[DataFrame], name: str) -> DataFrame:
    """The rows of all ``parts`` as one staged table, written one after the other: only one part's shuffles take disk at a time."""
    path = scratch_dir(parts[0].sparkSession, name)
    WRITTEN.append(path)
    for df in parts:
        df.write.mode("append").option("compression", "zstd").parquet(path)
    return parts[0].sparkSession.read.schema(parts[0].schema).parquet(path)


def release(spark: SparkSession, mark: int, keep: int = 0) -> None:
    """Delete the tables staged since ``WRITTEN`` had ``mark`` entries, but the last ``keep``; nothing that is still to be read may rest on them."""
    for path in (gone := WRITTEN[mark:len(WRITTEN) - keep]):
        delete(spark, path)
    del WRITTEN[mark:mark + len(gone)]


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends, not when the driver's JVM happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def hash_sample(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """About ``n`` rows (all if there are no more), those of the smallest hashes of ``columns``; never over 2 n.

    Rows are chosen where they are, by a threshold, so that no task sees the candidates of all others.
    """
    total = df.count()
    if total <= n:
        return df
    share = F.shiftrightunsigned(F.xxhash64(*map(col, columns)), 33) < int(n / total * (1 << 31))
    return df.filter(share).limit(2 * n)


def salted_join(rows: DataFrame, table: DataFrame, on: list[str], by: Column, ways: int = 32) -> DataFrame:
    """Left join of ``rows`` with a table of one row per key, each key dealt ``ways`` ways by the hash of ``by``.

    A key with a third of all rows then lands in ``ways`` tasks; the table, a row per key, is repeated as often.
    """
    salt, = fresh(rows, "salt")
    table = table.withColumn(salt, F.explode(F.array(*map(F.lit, range(ways)))))
    return rows.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(ways)).cast("int")).join(table, [*on, salt], "left").drop(salt)


def word_list(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8; none for a null.

    Word breaks are ASCII, so cutting the bytes cuts the same words as cutting the characters.
    """
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def text_key(text: str | None) -> int:
    """Spark's ``xxhash64(text)``: a content key that tells apart rows which share an id."""
    import xxhash
    if text is None:
        return 42
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
    return h - (1 << 64) if h >= 1 << 63 else h


def only_rows(df: DataFrame, rows: DataFrame, how: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` whose id and content key are (``left_semi``) or are not (``left_anti``) in ``rows`` (id, key)."""
    id2, key2, key = fresh(df, "id2", "key2", "key")
    rows = rows.select(F.col("id").alias(id2), F.col("key").alias(key2)).distinct()
    return df.withColumn(key, F.xxhash64(col(text_col))) \
        .join(rows, col(id_col).eqNullSafe(col(id2)) & (col(key) == col(key2)), how).drop(key)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if it is not installed for them."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if root not in paths:
        env["PYTHONPATH"] = ":".join([p for p in paths if p] + [root])


def slices(batches: Iterator, rows: int = 512) -> Iterator:
    """Record batches of at most ``rows`` rows, so that a task's Python objects and arrays stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: By module, what empties the tables that its tasks remember from one task to the next in a Python worker.
MEMOS: dict[str, Callable[[], None]] = {}


def forget(but: str | None = None) -> None:
    """Empty what tasks of other modules than ``but`` remember here: a worker lives on from query to query, and no two should add up."""
    for module, empty in MEMOS.items():
        if module != but:
            empty()


def give_back() -> None:
    """Free memory of this Python worker goes back to the system: it waits for its next task beside others."""
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def map_texts(df: DataFrame, step, schema: str) -> DataFrame:
    """``df.mapInArrow`` with ``step(batch as a dict of Python lists) -> dict of output lists``, batch by batch.

    What the module of ``step`` has in ``MEMOS`` stays for its next task, what others have goes.
    """
    importable(df.sparkSession)
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(step.__module__)
        for batch in slices(batches):
            made = step({n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)})
            yield pa.RecordBatch.from_arrays(
                [v if isinstance(v := made[f.name], pa.Array) else pa.array(v, f.type) for f in out], names=out.names)
        give_back()
    return df.mapInArrow(run, schema)


def id_type(df: DataFrame, name: str = "id") -> str:
    return df.schema[name].dataType.simpleString()


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: inside a lambda, Spark computes an outer expression per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def numbered(df: DataFrame, place: str, *order: str) -> DataFrame:
    """``df`` with ``place``: 1, 2, 3 .. over all rows by ascending ``order`` (nulls first), which must tell rows apart.

    Rows are dealt by ranges of ``order`` and written; each range is numbered on its own and shifted by the rows of
    the ranges before it. Only the ranges' counts (a row per shuffle partition) meet in one task.
    """
    part, shift = fresh(df, "range_no", "range_shift")
    rows = staged(df.repartitionByRange(*map(col, order)).withColumn(part, F.spark_partition_id()), "ranges")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = rows.groupBy(part).count().select(part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(shift))
    within = F.row_number().over(Window.partitionBy(part).orderBy(*map(col, order)))
    return rows.withColumn(place, within).join(F.broadcast(shifts), part) \
        .withColumn(place, F.col(place) + F.col(shift)).drop(part, shift)
