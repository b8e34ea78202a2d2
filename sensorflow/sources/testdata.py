"""Map the shared test tables onto the sensor data model.

``events`` plays the fact table and ``customer`` (+ ``nation``) the sensor
dimension:

* SENSORS: customers with ``c_custkey % 10 <> 3`` (so some readings have no
  sensor), ``sensor_id = c_custkey``, location = nation name, type = market
  segment, unit ``C``, bounds 1.0 .. 100.0.
* M_user: one reading per event, ``sensor_id = user_id``, ``created_at = ts +
  (event_id % 7) s``, flag from the dimension.
* M_type: the same readings keyed by ``event_type`` (few, dense sensors) with
  TYPE_SENSORS, the event types seen in the data, as dimension.

Everything is derived by Spark from the given tables, so the work grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.operators.joins import dim_join
from sensorflow.operators.quality import flag_quality
from sensorflow.session import materialize

# Fixed values of the test mapping.
SENSOR_UNIT = "C"
SENSOR_MIN = 1.0
SENSOR_MAX = 100.0
SENSOR_CREATED_AT = "2024-01-01 00:00:00"
SILENT_MODULUS = 10
SILENT_REMAINDER = 3
CREATED_AT_LAG_MODULUS = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sensors_from_customers(customer: DataFrame, nation: DataFrame, only_registered: bool = True) -> DataFrame:
    """The sensor dimension; ``only_registered=False`` maps every customer."""
    c = customer.filter(F.col("c_custkey") % SILENT_MODULUS != SILENT_REMAINDER) if only_registered else customer
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("location"))
    j = dim_join(c.select("c_custkey", "c_nationkey", "c_mktsegment"), n, "c_nationkey", "inner")
    return j.select(
        F.col("c_custkey").cast("string").alias("sensor_id"),
        F.col("location"),
        F.col("c_mktsegment").alias("sensor_type"),
        F.lit(SENSOR_UNIT).alias("unit"),
        F.lit(SENSOR_MIN).alias("min_value"),
        F.lit(SENSOR_MAX).alias("max_value"),
        F.expr(f"TIMESTAMP_NTZ '{SENSOR_CREATED_AT}'").alias("created_at"),
    )


def type_sensors(events: DataFrame) -> DataFrame:
    """One dimension row per event type present in the data."""
    return (events.select("event_type").distinct().select(
        F.col("event_type").alias("sensor_id"),
        F.lit("all").alias("location"),
        F.col("event_type").alias("sensor_type"),
        F.lit(SENSOR_UNIT).alias("unit"),
        F.lit(SENSOR_MIN).alias("min_value"),
        F.lit(SENSOR_MAX).alias("max_value"),
        F.expr(f"TIMESTAMP_NTZ '{SENSOR_CREATED_AT}'").alias("created_at"),
    ))


def raw_measurements(events: DataFrame, key: str = "user_id") -> DataFrame:
    """Unflagged readings: id, sensor_id, timestamp, value, created_at."""
    return events.select(
        F.col("event_id").alias("id"),
        F.col(key).cast("string").alias("sensor_id"),
        F.col("ts").alias("timestamp"),
        F.col("value"),
        F.timestamp_add("SECOND", F.col("event_id") % CREATED_AT_LAG_MODULUS, F.col("ts")).alias("created_at"),
    )


def measurements(events: DataFrame, sensors: DataFrame, key: str = "user_id") -> DataFrame:
    """id, sensor_id, timestamp, value, quality_flag, created_at."""
    return flag_quality(raw_measurements(events, key), sensors)


_SHARED: dict = {}


class TestTables:
    __test__ = False  # not a pytest class

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "TestTables":
        """One instance per session and folder, so the small derived dimensions
        are computed once per session (the test tables are read-only)."""
        key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        hit = _SHARED.get(key)
        if hit is None or hit.spark is not spark:
            hit = _SHARED[key] = cls(spark, sf_dir)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return hit

    """Lazy handles on the derived tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        # NTZ truncation and naive ISO parsing assume a UTC session clock.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict = {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def raw(self, name: str) -> DataFrame:
        return self._get(("raw", name), lambda: table(self.spark, self.sf_dir, name))

    @property
    def events(self) -> DataFrame:
        return self.raw("events")

    @property
    def sensors(self) -> DataFrame:
        # The dimension is derived once and kept in the shared checkpoint folder,
        # as a stored sensors table would be; facts are always derived in full.
        return self._get("sensors", lambda: materialize(
            sensors_from_customers(self.raw("customer"), self.raw("nation"))))

    @property
    def type_sensors(self) -> DataFrame:
        # one row per event type: computed once, kept in the shared checkpoint folder
        return self._get("type_sensors", lambda: materialize(type_sensors(self.events)))

    @property
    def m_user(self) -> DataFrame:
        return self._get("m_user", lambda: measurements(self.events, self.sensors, "user_id"))

    @property
    def m_type(self) -> DataFrame:
        return self._get("m_type", lambda: measurements(self.events, self.type_sensors, "event_type"))

    @property
    def as_of(self) -> dt.datetime:
        """max(ts) of the events: the fixed 'now' of every lookback."""
        return self._get("as_of", lambda: self.events.agg(F.max("ts").alias("m")).first()["m"])


__all__ = ["TestTables", "sensors_from_customers", "type_sensors", "raw_measurements",
           "measurements", "table"]


# ---------------------------------------------------------------- landing messages

EPOCH = "1970-01-01 00:00:00"

# Damage applied by ``event_id % 50`` to the generated messages.
DAMAGE_MODULUS = 50
DAMAGE_RULES = {
    0: "truncated text (bad_json)",
    1: "unit missing (bad_schema: unit)",
    2: "timestamp 'not-a-time' (bad_schema: timestamp)",
    3: "value as numeric string (valid)",
    4: "value as text 'high' (bad_schema: value)",
    5: "timestamp in epoch milliseconds (valid)",
    6: "sensor_id as a number (bad_schema: sensor_id)",
    7: "value true (valid, 1.0)",
    8: "ISO time with +02:00 offset (valid)",
    9: "value NaN literal (valid, out_of_range)",
    10: "top-level list (other)",
    11: "JSON null (other)",
}


def _q(c):
    return F.concat(F.lit('"'), c, F.lit('"'))


def messages_from_events(events: DataFrame, damaged: bool = True, key: str = "user_id",
                         time_format: str = "mixed") -> DataFrame:
    """One JSON reading per event, in the producer's shape: msg_id, topic, body.

    ``time_format='mixed'``: even event ids carry an ISO ``..Z`` time, odd ones
    integer epoch seconds; ``'epoch'``: all epoch seconds (the second ingest
    path's format). With ``damaged`` the rules of ``DAMAGE_RULES`` are applied.
    """
    r = F.col("event_id") % DAMAGE_MODULUS if damaged else F.lit(-1)
    ts = F.col("ts")
    micros = F.timestamp_diff("MICROSECOND", F.expr(f"TIMESTAMP_NTZ '{EPOCH}'"), ts)
    sid_txt = F.col(key).cast("string")
    iso_z = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    iso_off = F.concat(F.date_format(F.timestamp_add("HOUR", F.lit(2), ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                       F.lit("+02:00"))
    secs = F.floor(micros / 1_000_000).cast("string")
    millis = F.floor(micros / 1_000).cast("string")
    ts_json = (F.when(r == 2, _q(F.lit("not-a-time"))).when(r == 5, millis).when(r == 8, _q(iso_off))
                .when((F.col("event_id") % 2 == 0) & F.lit(time_format == "mixed"), _q(iso_z)).otherwise(secs))
    v_txt = F.col("value").cast("string")
    val_json = (F.when(r == 3, _q(v_txt)).when(r == 4, _q(F.lit("high"))).when(r == 7, F.lit("true"))
                 .when(r == 9, F.lit("NaN")).otherwise(v_txt))
    sid_json = F.when(r == 6, sid_txt).otherwise(_q(sid_txt))
    unit_json = F.when(r == 1, F.lit("")).otherwise(F.lit(', "unit": "C"'))
    loc = F.concat(F.lit('{"lat": '), (F.col("event_id") % 90).cast("string"), F.lit(', "lng": '),
                   (F.col("event_id") % 180).cast("string"), F.lit("}"))
    body = F.concat(F.lit('{"sensor_id": '), sid_json, F.lit(', "type": '), _q(F.col("event_type")),
                    F.lit(', "value": '), val_json, unit_json, F.lit(', "location": '), loc,
                    F.lit(', "timestamp": '), ts_json, F.lit("}"))
    topic = F.concat(F.lit("sensors/"), F.col("event_type"), F.lit("/"), sid_txt)
    staged = events.select(
        F.col("event_id").alias("msg_id"), topic.alias("topic"), body.alias("_body"), r.alias("_r"),
        F.timestamp_add("SECOND", F.col("event_id") % CREATED_AT_LAG_MODULUS, ts).alias("arrival_time"))
    b, rr = F.col("_body"), F.col("_r")
    body = (F.when(rr == 0, F.substring(b, 1, 40)).when(rr == 10, F.concat(F.lit("["), b, F.lit("]")))
             .when(rr == 11, F.lit("null")).otherwise(b))
    return staged.select("msg_id", "topic", body.alias("body"), "arrival_time")


def write_landing(messages: DataFrame, path: str, files: int = 8) -> None:
    """Land messages as JSON-lines text files (one message per line).

    Files are cut by arrival time (range partitioning), as a collector would
    roll them, so each file holds one time slice.
    """
    (messages.repartitionByRange(files, "arrival_time", "msg_id").sortWithinPartitions("arrival_time", "msg_id")
             .select("body").write.mode("overwrite").text(path))
