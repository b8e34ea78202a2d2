"""Sensor dimension: load from a table or the nested catalogue file, and
insert-if-absent maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow import schemas as S

DIM_COLUMNS = ["sensor_id", "location", "sensor_type", "unit", "min_value", "max_value"]


def read_sensors(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The sensors table (S4), projected to the dimension columns."""
    df = spark.read.format(fmt).load(path)
    cols = [c for c in DIM_COLUMNS + ["created_at"] if c in df.columns]
    return df.select(*cols)


def read_sensor_catalog(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Flatten the nested catalogue file(s) (S5): one row per sensor.

    ``multi_line=True`` reads pretty-printed files holding one document each;
    ``False`` reads JSON lines, one ``{"sensors": [..]}`` document per line.

    ``location`` keeps the JSON text of the coordinates (the table form holds
    text), ``lat``/``lng`` and ``description`` are kept as columns, and
    ``range.min/max`` become the bounds.
    """
    raw = spark.read.schema(S.SENSOR_CATALOG).option("multiLine", multi_line).json(path)
    return catalog_to_sensors(raw)


def catalog_to_sensors(raw: DataFrame) -> DataFrame:
    s = raw.select(F.explode("sensors").alias("s")).select("s.*")
    return s.select(
        F.col("id").alias("sensor_id"),
        F.to_json(F.col("location")).alias("location"),
        F.col("type").alias("sensor_type"),
        F.col("unit"),
        F.col("range.min").cast("double").alias("min_value"),
        F.col("range.max").cast("double").alias("max_value"),
        F.col("location.lat").alias("lat"),
        F.col("location.lng").alias("lng"),
        F.col("description"),
    )


def write_sensor_catalog(sensors: DataFrame, path: str, sensors_per_file: int = 10_000) -> None:
    """Write the dimension in the nested catalogue shape, as JSON lines.

    Sensors are hashed into groups of about ``sensors_per_file``; each group
    becomes one ``{"sensors": [..]}`` document, so no document (and no task)
    holds an unbounded number of sensors.
    """
    n = sensors.count()
    groups = max(1, -(-n // sensors_per_file))
    loc = F.col("location")
    entry = F.struct(
        F.col("sensor_id").alias("id"),
        F.struct(F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lng")).alias("location")
        if "lat" not in sensors.columns else F.struct("lat", "lng").alias("location"),
        F.col("sensor_type").alias("type"), F.col("unit"),
        F.struct(F.col("min_value").alias("min"), F.col("max_value").alias("max")).alias("range"),
        loc.alias("description"))
    docs = (sensors.groupBy(F.pmod(F.xxhash64("sensor_id"), F.lit(groups)).alias("_g"))
                   .agg(F.sort_array(F.collect_list(entry)).alias("sensors")))
    docs.select(F.to_json(F.struct("sensors")).alias("value")).write.mode("overwrite").text(path)


def insert_if_absent(new: DataFrame, existing: DataFrame, keys=("sensor_id",)) -> DataFrame:
    """Rows of ``new`` whose key is not yet present (``ON CONFLICT DO NOTHING``, S10).

    Within ``new`` the first row per key wins (deterministically, by all
    columns); the result is what to append.
    """
    keys = list(keys)
    rest = [c for c in new.columns if c not in keys]
    first = new.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in rest])).alias("_r")) \
        .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
    return first.join(existing.select(*keys), keys, "left_anti").select(*new.columns)


__all__ = ["read_sensors", "read_sensor_catalog", "write_sensor_catalog", "catalog_to_sensors", "insert_if_absent", "DIM_COLUMNS"]
