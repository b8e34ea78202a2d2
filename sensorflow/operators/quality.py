"""Ingest validation and data-quality operators (parse, flag, route, keys, nulls).

All rules are built-in expressions: the JSON is parsed into a VARIANT so the
JSON type of every field is still known, and the validator's type rules are
checked on it without a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow import schemas as S
from sensorflow.functions.numeric import clamp, is_finite, round_half_up
from sensorflow.functions.text import NONFINITE_LITERAL, NONFINITE_TAGGED
from sensorflow.functions.time import parse_event_time
from sensorflow.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, dim_join, fits_broadcast

_NUMERIC_TYPE = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


# --------------------------------------------------------------------------- V3

def flag_quality(m: DataFrame, sensors: DataFrame, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Set ``quality_flag``: unknown_sensor, then out_of_range, then valid.

    Bounds are inclusive. A non-finite value (NaN, +-Infinity) is out_of_range.
    The dimension is joined left (broadcast when its size is proven small), so
    rows of unknown sensors stay and are flagged, never dropped.
    """
    # the size check runs on the caller's table (memoised when it is cached),
    # the projection of it is what gets broadcast
    fits = fits_broadcast(sensors, max_broadcast_bytes or DEFAULT_MAX_BROADCAST_BYTES)
    dim = sensors.select("sensor_id", F.col("min_value").alias("_lo"),
                         F.col("max_value").alias("_hi"), F.lit(True).alias("_known"))
    j = dim_join(m.drop("quality_flag"), dim, "sensor_id", "left", fits=fits)
    v = F.col("value")
    flag = (F.when(F.col("_known").isNull(), F.lit(S.FLAG_UNKNOWN))
            .when(~is_finite(v) | (v < F.col("_lo")) | (v > F.col("_hi")), F.lit(S.FLAG_OUT_OF_RANGE))
            .otherwise(F.lit(S.FLAG_VALID)))
    cols = [c for c in m.columns if c != "quality_flag"]
    out_cols = []
    for c in cols:
        out_cols.append(F.col(c))
        if c == "value":
            out_cols.append(flag.alias("quality_flag"))
    if "value" not in cols:
        out_cols.append(flag.alias("quality_flag"))
    return j.select(*out_cols)


# --------------------------------------------------------------------------- V8

def with_defaults(m: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Column defaults of the fact table: flag 'valid', created_at = ingest time."""
    out = m
    if "quality_flag" in m.columns:
        out = out.withColumn("quality_flag", F.coalesce(F.col("quality_flag"), F.lit(S.FLAG_VALID)))
    else:
        out = out.withColumn("quality_flag", F.lit(S.FLAG_VALID))
    if ingest_time is not None:
        if "created_at" in m.columns:
            out = out.withColumn("created_at", F.coalesce(F.col("created_at"), ingest_time))
        else:
            out = out.withColumn("created_at", ingest_time)
    return out


# --------------------------------------------------------------------------- V1 / V2

_FALLBACK_SCHEMA = ("sensor_id STRING, timestamp STRING, value DOUBLE, unit STRING, "
                    "_corrupt_record STRING")


_TAG = "\u0001"


def _untagged(s: Column) -> Column:
    """A string field, unless it is a tagged non-finite literal (not a string in the source)."""
    return F.when(~s.startswith(_TAG), s)


def _tagged_double(s: Column) -> Column:
    """A string ``value``: tagged literals become NaN/+-Infinity, other text is cast."""
    lit = F.substring(s, 2, 20)
    return (F.when(s.startswith(_TAG), F.when(lit == "NaN", F.lit(float("nan")))
                                        .when(lit == "Infinity", F.lit(float("inf")))
                                        .when(lit == "-Infinity", F.lit(float("-inf"))))
             .otherwise(numeric_text(s)))


def numeric_text(s: Column) -> Column:
    """A decimal number, or nan / inf / infinity in any case, with optional sign and
    blanks around; NULL for other text (type suffixes such as ``1d`` included)."""
    word = F.lower(F.trim(F.regexp_replace(s, r"[\t\n\r\x0b\f]", " ")))
    digits = F.regexp_replace(word, "(?<=[0-9])_(?=[0-9])", "")
    return (F.when(digits.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?$"), digits.try_cast("double"))
             .when(word.rlike("^[+-]?nan$"), F.lit(float("nan")))
             .when(word.rlike(r"^\+?inf(inity)?$"), F.lit(float("inf")))
             .when(word.rlike("^-inf(inity)?$"), F.lit(float("-inf"))))


def _vtype(v: Column, field: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))


def parse_readings(df: DataFrame, body_col: str = "body", spread: bool = False) -> DataFrame:
    """Decode and validate one JSON reading per row.

    Adds ``sensor_id, timestamp, value, unit`` and ``error_class`` (NULL when
    the reading is valid, ``bad_json`` when the text does not decode,
    ``bad_schema`` when a required field is absent or of the wrong type, ``other``
    when the JSON is no object and so has no fields) plus ``error_field``, the
    first field that failed (NULL unless ``bad_schema``).

    Rules: ``sensor_id`` and ``unit`` must be strings; ``value`` may be a
    number, a numeric string or a boolean; ``timestamp`` is epoch seconds
    (milliseconds above 2e10) when numeric and ISO-8601 when a string (a
    numeric string is rejected). Extra fields are ignored. Bodies with bare
    NaN/Infinity literals, which the VARIANT decoder refuses, are decoded again
    with those literals quoted and tagged, so every field keeps its JSON type:
    a tagged ``value`` becomes the non-finite double, a tagged string field is
    rejected. Text that still does not decode (e.g. duplicate keys) is read
    through ``from_json`` as a last resort, where field types are not visible.

    ``spread`` rebalances a batch that comes as few big splits before decoding.

    The work is staged in successive projections (decode once, type once,
    extract once) so no decoder is evaluated more than once per row.
    """
    body = F.col(body_col)
    v = F.col("_v")
    fb = F.col("_fb")
    src = df.hint("rebalance") if spread and not df.isStreaming else df
    # Decode through one-row generators: predicates on the result (e.g. the
    # valid/rejected split) cannot be pushed below a Generate, so the decoders
    # are never re-inlined into a filter condition.
    d = src.select("*", F.inline(F.array(F.struct(F.try_parse_json(body).alias("_v0")))))
    tagged = F.regexp_replace(body, NONFINITE_LITERAL, NONFINITE_TAGGED)
    retry = F.when(F.col("_v0").isNull() & body.isNotNull(), F.try_parse_json(tagged))
    d = d.select("*", F.inline(F.array(F.struct(retry.alias("_v1")))))
    d = d.withColumn("_v", F.coalesce(F.col("_v0"), F.col("_v1")))
    fallback = F.when(v.isNull() & body.isNotNull(), F.from_json(
        body, _FALLBACK_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"}))
    d = d.select("*", F.inline(F.array(F.struct(fallback.alias("_fb")))))
    d = d.withColumns({f"_t_{f}": _vtype(v, f) for f in ("sensor_id", "timestamp", "value", "unit")})
    t_sid, t_ts, t_val, t_unit = (F.col(f"_t_{f}") for f in ("sensor_id", "timestamp", "value", "unit"))
    # what has one of the fields is an object: the whole value's type is spelled out for the others only
    d = d.withColumn("_t_root", F.when(F.coalesce(t_sid, t_ts, t_val, t_unit).isNull(), F.schema_of_variant(v)).otherwise(F.lit("OBJECT")))

    fb_ok = v.isNull() & fb.isNotNull() & fb["_corrupt_record"].isNull()
    fb_ts_txt = fb["timestamp"]
    fb_ts_num = F.when(fb_ts_txt.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"),
                       fb_ts_txt.try_cast("double"))
    d = d.withColumns({
        "_fb_ok": fb_ok,
        "_ts_num": F.when(v.isNotNull(), F.when(t_ts.rlike(_NUMERIC_TYPE),
                                                F.try_variant_get(v, "$.timestamp", "double")))
                    .otherwise(fb_ts_num),
        "_ts_txt": F.when(v.isNotNull(), F.when(t_ts == "STRING", F.try_variant_get(v, "$.timestamp", "string")))
                    .otherwise(fb_ts_txt),
    })
    ok_v = v.isNotNull()
    fb_ok = F.col("_fb_ok")
    d = d.withColumns({
        "_sid": F.when(ok_v, F.when(t_sid == "STRING", _untagged(F.try_variant_get(v, "$.sensor_id", "string"))))
                 .when(fb_ok, fb["sensor_id"]),
        "_unit": F.when(ok_v, F.when(t_unit == "STRING", _untagged(F.try_variant_get(v, "$.unit", "string"))))
                  .when(fb_ok, fb["unit"]),
        "_val": F.when(ok_v, F.when(t_val == "STRING", _tagged_double(F.try_variant_get(v, "$.value", "string")))
                                   .otherwise(F.when(t_val.rlike(_NUMERIC_TYPE) | (t_val == "BOOLEAN"),
                                                     F.try_variant_get(v, "$.value", "double"))))
                 .when(fb_ok, fb["value"]),
        "_ts": F.when(ok_v | fb_ok, parse_event_time(F.col("_ts_num"), F.col("_ts_txt"))),
        "_decoded": ok_v | fb_ok,
    })
    sid, ts, val, unit = F.col("_sid"), F.col("_ts"), F.col("_val"), F.col("_unit")
    no_object = ok_v & ~F.col("_t_root").startswith("OBJECT")
    d = d.withColumn("_ef", F.when(~F.col("_decoded") | no_object, F.lit(None))
                     .when(sid.isNull(), F.lit("sensor_id"))
                     .when(ts.isNull(), F.lit("timestamp"))
                     .when(val.isNull(), F.lit("value"))
                     .when(unit.isNull(), F.lit("unit")).cast("string"))
    error_class = (F.when(~F.col("_decoded"), F.lit(S.ERR_JSON))
                   .when(no_object, F.lit(S.ERR_OTHER))
                   .when(F.col("_ef").isNotNull(), F.lit(S.ERR_SCHEMA)))
    d = d.withColumn("_ec", error_class)
    ok = F.col("_ec").isNull()
    return d.select(
        *[F.col(c) for c in df.columns],
        F.when(ok, sid).alias("sensor_id"),
        F.when(ok, ts).alias("timestamp"),
        F.when(ok, val).alias("value"),
        F.when(ok, unit).alias("unit"),
        F.col("_ec").alias("error_class"),
        F.col("_ef").alias("error_field"),
    )


# --------------------------------------------------------------------------- V4 / V5

def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) branches of a parsed batch; together they hold every row."""
    return (parsed.filter(F.col("error_class").isNull()),
            parsed.filter(F.col("error_class").isNotNull()))


def quarantine(rejected: DataFrame, body_col: str = "body", ingest_time: Column | None = None) -> DataFrame:
    """Rows to keep for investigation: raw text, error class and field, ingest time."""
    cols = [c for c in ("msg_id", "topic", "ingest_file") if c in rejected.columns]
    return rejected.select(
        *cols, F.col(body_col).alias("body"), "error_class", "error_field",
        (ingest_time if ingest_time is not None else F.lit(None).cast("timestamp_ntz")).alias("quarantined_at"),
    )


def quarantine_flags(flagged: DataFrame) -> DataFrame:
    """Parsed readings whose sensor is unknown: kept apart instead of failing the batch."""
    return flagged.filter(F.col("quality_flag") == S.FLAG_UNKNOWN)


# --------------------------------------------------------------------------- V6

def find_duplicates(m: DataFrame, keys=("sensor_id", "timestamp")) -> DataFrame:
    """Keys that occur more than once, with their count and id range."""
    keys = list(keys)
    return (m.groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id"),
                  F.max("id").alias("last_id"))
             .filter(F.col("copies") > 1))


def dedupe(m: DataFrame, keys=("sensor_id", "timestamp"), order=("created_at", "id")) -> DataFrame:
    """One row per key: the first by ``order``.

    ``min_by`` over a struct is a partial (map-side) aggregate, so a key with
    many copies is reduced before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in m.columns if c not in keys]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return (m.groupBy(*keys).agg(best.alias("_r"))
             .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
             .select(*m.columns))


# --------------------------------------------------------------------------- V7

def check_keys(df: DataFrame, keys) -> DataFrame:
    """Primary-key check: key values held by more than one row."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def check_orphans(fact: DataFrame, dim: DataFrame, key: str = "sensor_id") -> DataFrame:
    """Foreign-key check: fact keys absent from the dimension, with row counts."""
    orphans = dim_join(fact, dim.select(key), key, "left_anti")
    return orphans.groupBy(key).agg(F.count(F.lit(1)).alias("orphan_rows"))


# --------------------------------------------------------------------------- V9

def check_not_null(df: DataFrame, cols) -> DataFrame:
    """NOT NULL check over ``cols`` in a single pass: one row per column."""
    cols = list(cols)
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', _z{i}" for i, c in enumerate(cols))
    long = one.selectExpr("_n", f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")
    return long.select(
        "column_name", "null_count", F.col("_n").alias("row_count"),
        F.when(F.col("null_count") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))


# --------------------------------------------------------------------------- F14

def clamp_to_range(m: DataFrame, sensors: DataFrame, digits: int = 2) -> DataFrame:
    """Repair readings into their sensor's bounds and round them, as the producer does.

    Readings of unknown sensors or with non-finite values are left unchanged.
    """
    dim = sensors.select("sensor_id", F.col("min_value").alias("_lo"), F.col("max_value").alias("_hi"))
    j = dim_join(m, dim, "sensor_id", "left")
    fixable = F.col("_lo").isNotNull() & is_finite(F.col("value"))
    new = F.when(fixable, round_half_up(clamp("value", "_lo", "_hi"), digits)).otherwise(F.col("value"))
    return j.select(*[new.alias("value") if c == "value" else F.col(c) for c in m.columns],
                    (fixable & ((F.col("value") < F.col("_lo")) | (F.col("value") > F.col("_hi")))).alias("clamped"))


__all__ = [
    "flag_quality", "with_defaults", "parse_readings", "split_valid", "quarantine",
    "quarantine_flags", "find_duplicates", "dedupe", "check_keys", "check_orphans",
    "check_not_null", "clamp_to_range",
]
