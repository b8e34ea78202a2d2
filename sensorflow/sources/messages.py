"""Landing-file message sources (batch and streaming) and topic handling.

A landing file holds one message per line: either a bare reading
(``{"sensor_id": .., "timestamp": .., "value": .., "unit": ..}``) or a raw
envelope ``{"topic": .., "timestamp": <arrival>, "payload": {..}}`` as the raw
archive stores it, so replaying the archive is the same read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.text import NONFINITE_LITERAL, NONFINITE_TAGGED, TAGGED_TEXT, topic_of, topic_regex


# A line as the raw archive writes it: its head, then the verbatim body as the last field.
ARCHIVED = (r'^(\{"topic":(?:null|"(?:[^"\\]++|\\.)*+"),"timestamp":(?:null|"[^"]*+")(?:,"id":-?[0-9]++)?+),"payload":(.*)\}$')


def messages_from_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """(line, file) rows -> topic, body, arrival_time, msg_id, ingest_file.

    Envelopes are unwrapped to their verbatim body and id: those of the raw
    archive by their head, whose last field is the body as it came; others by a
    ``payload_text``, or a ``topic`` and a ``payload``. Bare readings keep the
    whole line as body, get the topic their sensor id maps to (NULL when the line
    does not decode) and have no ``msg_id``.

    Each line is decoded once: the steps sit behind one-row generators, below
    which no later filter is pushed.
    """
    line = F.col(line_col)
    extra = [c for c in lines.columns if c != line_col]

    def step(df: DataFrame, **made) -> DataFrame:
        return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))
    d = step(lines, _head=F.regexp_extract(line, ARCHIVED, 1), _rest=F.regexp_extract(line, ARCHIVED, 2))
    d = step(d, _own=(F.col("_head") != "") & F.try_parse_json("_rest").isNotNull())
    d = step(d, _v0=F.try_parse_json(F.when(F.col("_own"), F.concat("_head", F.lit("}"))).otherwise(line)))
    # bare NaN / Infinity literals are decoded as tagged strings, as the validator does
    d = step(d, _v=F.coalesce("_v0", F.when(F.col("_v0").isNull(), F.try_parse_json(F.regexp_replace(line, NONFINITE_LITERAL, NONFINITE_TAGGED)))))
    v = F.col("_v")
    t_payload, t_text, t_topic, t_sid = (F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant"))
                                         for f in ("payload", "payload_text", "topic", "sensor_id"))
    d = step(d, _env=F.col("_own") | F.coalesce((t_text == "STRING") | ((t_topic == "STRING") & t_payload.isNotNull()), F.lit(False)),
             _sid=F.when(t_sid == "STRING", F.try_variant_get(v, "$.sensor_id", "string")))
    env = F.col("_env")
    payload = F.coalesce(F.try_variant_get(v, "$.payload_text", "string"),
                         F.regexp_replace(F.to_json(F.try_variant_get(v, "$.payload", "variant")), TAGGED_TEXT, "$1"))
    topic = F.when(env, F.try_variant_get(v, "$.topic", "string")).otherwise(topic_of(F.col("_sid")))
    body = F.when(F.col("_own"), F.col("_rest")).when(env, payload).otherwise(line)
    arrival = F.when(env, F.try_variant_get(v, "$.timestamp", "string").try_cast("timestamp").cast("timestamp_ntz"))
    msg_id = F.when(env, F.try_variant_get(v, "$.id", "bigint"))
    return d.select(topic.alias("topic"), body.alias("body"), arrival.alias("arrival_time"), msg_id.alias("msg_id"), *extra)


def read_messages(spark: SparkSession, path: str, streaming: bool = False, max_files_per_trigger: int | None = None,
                  max_bytes_per_trigger: int | str | None = None, archive_read_files: str | None = None, keep=(),
                  spread: int | None = None) -> DataFrame:
    """Read landing files as messages (S1); ``streaming=True`` returns a stream.

    Each row carries its source file (``ingest_file``) for lineage and ids;
    ``keep`` names partition columns of the folder to keep beside. A micro-batch takes at most so many files or bytes; files whose batch is done
    move to ``archive_read_files`` where that is given, below their own path. ``spread`` deals the lines to so many
    tasks before they are decoded, however few or uneven the files are.
    """
    if streaming:
        options = {"maxFilesPerTrigger": max_files_per_trigger, "maxBytesPerTrigger": max_bytes_per_trigger}
        if archive_read_files:
            options |= {"cleanSource": "archive", "sourceArchiveDir": archive_read_files}
        r = spark.readStream.format("text")
        for k, v in options.items():
            r = r.option(k, v) if v is not None else r
        lines = r.load(path)
    else:
        lines = spark.read.format("text").load(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("ingest_file"), *keep)
    return messages_from_lines(lines.repartition(spread) if spread else lines)


def filter_topic(df: DataFrame, pattern: str, topic_col: str = "topic") -> DataFrame:
    """Keep messages whose topic matches an MQTT filter such as ``sensors/#`` (S2)."""
    return df.filter(F.col(topic_col).rlike(topic_regex(pattern)))


__all__ = ["messages_from_lines", "read_messages", "filter_topic", "topic_of"]
