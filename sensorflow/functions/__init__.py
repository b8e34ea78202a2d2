"""Column-expression helpers. Every helper returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from sensorflow.functions.numeric import (
    clamp, corr_from_moments, is_finite, pct, round_half_up, round6,
)
from sensorflow.functions.text import pretty_size, topic_of, topic_regex
from sensorflow.functions.time import (
    epoch_seconds_between, parse_event_time, parse_interval, since, trunc_ntz, ts_lit,
    resolve_as_of, before,
)

__all__ = [
    "clamp", "corr_from_moments", "is_finite", "pct", "round_half_up", "round6",
    "pretty_size", "topic_of", "topic_regex",
    "epoch_seconds_between", "parse_event_time", "parse_interval", "since", "before",
    "trunc_ntz", "ts_lit", "resolve_as_of",
]
