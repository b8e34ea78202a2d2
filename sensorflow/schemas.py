"""Table and message schemas of the sensor data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Quality flags, in precedence order.
FLAG_UNKNOWN = "unknown_sensor"
FLAG_OUT_OF_RANGE = "out_of_range"
FLAG_VALID = "valid"
QUALITY_FLAGS = [FLAG_VALID, FLAG_OUT_OF_RANGE, FLAG_UNKNOWN]

# Error classes of rejected messages.
ERR_JSON = "bad_json"
ERR_SCHEMA = "bad_schema"
ERR_OTHER = "other"

SENSORS = T.StructType([
    T.StructField("sensor_id", T.StringType(), False),
    T.StructField("location", T.StringType(), False),
    T.StructField("sensor_type", T.StringType(), False),
    T.StructField("unit", T.StringType(), False),
    T.StructField("min_value", T.DoubleType(), False),
    T.StructField("max_value", T.DoubleType(), False),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

MEASUREMENTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("sensor_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("value", T.DoubleType(), False),
    T.StructField("quality_flag", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

MEASUREMENTS_1MIN = T.StructType([
    T.StructField("sensor_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("avg_value", T.DoubleType(), False),
    T.StructField("min_value", T.DoubleType(), False),
    T.StructField("max_value", T.DoubleType(), False),
    T.StructField("sample_count", T.LongType(), False),
])

DATA_QUALITY = T.StructType([
    T.StructField("sensor_id", T.StringType(), False),
    T.StructField("check_timestamp", T.TimestampNTZType(), False),
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("metric_value", T.DoubleType(), True),
    T.StructField("status", T.StringType(), False),
])

# A landed message: the topic it came on and its undecoded body.
MESSAGE = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("body", T.StringType(), True),
])

# Sensor catalogue file: {"sensors": [{id, location{lat,lng}, type, unit, range{min,max}, description}]}
SENSOR_CATALOG = T.StructType([
    T.StructField("sensors", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("location", T.StructType([
            T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())])),
        T.StructField("type", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("range", T.StructType([
            T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType())])),
        T.StructField("description", T.StringType()),
    ]))),
])

# Row shape of the second (denormalised) ingest path.
WIDE_MEASUREMENTS = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("value", T.FloatType()),
    T.StructField("unit", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])
