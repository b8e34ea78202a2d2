"""String helpers: MQTT topics and human-readable sizes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Topic layout of the message producer.
TOPIC_PREFIX = "sensors/"


# Bare non-finite number literals in value position (after ':' '[' or ',',
# before ',' ']' or '}'), quoted with a U+0001 tag so the VARIANT decoder takes them.
NONFINITE_LITERAL = r"([:\[,]\s*)(-?Infinity|NaN)(?=\s*[,}\]])"
NONFINITE_TAGGED = r'$1"\\u0001$2"'
# Such a tagged literal in the text of a decoded value, where the tag is written as an escape.
TAGGED_TEXT = r'"\\u0001(-?Infinity|NaN)"'


def topic_of(sensor_id_col) -> Column:
    """Topic a reading is published on: ``sensors/`` + id with blanks as ``_``."""
    c = F.col(sensor_id_col) if isinstance(sensor_id_col, str) else sensor_id_col
    return F.concat(F.lit(TOPIC_PREFIX), F.replace(c, F.lit(" "), F.lit("_")))


def topic_regex(pattern: str) -> str:
    """Translate an MQTT subscription filter into an anchored Java regex.

    ``+`` matches exactly one level, a trailing ``#`` matches the parent level
    and any number of further levels.
    """
    levels = pattern.split("/")
    out = []
    for i, lvl in enumerate(levels):
        if lvl == "#":
            if i != len(levels) - 1:
                raise ValueError("'#' must be the last level of a topic filter")
            if out:
                return "^" + "/".join(out) + "(/.*)?$"
            return "^.*$"
        out.append("[^/]+" if lvl == "+" else re.escape(lvl))
    return "^" + "/".join(out) + "$"


# PostgreSQL pg_size_pretty units. A unit is used while the
# (already shifted) size is below its limit; every unit above bytes is
# half-rounded.
SIZE_UNITS = ["bytes", "kB", "MB", "GB", "TB", "PB"]
SIZE_LIMIT_BYTES = 10 * 1024
SIZE_LIMIT_ROUNDED = 20 * 1024 - 1


def pretty_size(bytes_col) -> Column:
    """``pg_size_pretty`` for non-negative byte counts."""
    size = (F.col(bytes_col) if isinstance(bytes_col, str) else bytes_col).cast("long")
    expr = None
    shifted = size
    for i, unit in enumerate(SIZE_UNITS):
        if i == 0:
            cond = size < SIZE_LIMIT_BYTES
            text = F.concat(size.cast("string"), F.lit(" bytes"))
            shift = 9  # keep one extra bit for the half-rounding of the next unit
        else:
            cond = shifted < SIZE_LIMIT_ROUNDED if i < len(SIZE_UNITS) - 1 else F.lit(True)
            text = F.concat(F.floor((shifted + 1) / 2).cast("long").cast("string"), F.lit(" " + unit))
            shift = 10
        expr = F.when(cond, text) if expr is None else expr.when(cond, text)
        shifted = F.shiftright(shifted, shift)
    return expr


__all__ = ["topic_of", "topic_regex", "pretty_size", "TOPIC_PREFIX"]
