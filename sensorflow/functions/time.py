"""Time helpers for TIMESTAMP_NTZ columns (session time zone pinned to UTC)."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNITS = {
    "microsecond": "microseconds", "millisecond": "milliseconds", "second": "seconds",
    "minute": "minutes", "hour": "hours", "day": "days", "week": "weeks",
}


def parse_interval(text: str | dt.timedelta) -> dt.timedelta:
    """'24 hours', '10 minutes', '7 days', '1 hour 30 minutes' -> timedelta."""
    if isinstance(text, dt.timedelta):
        return text
    parts = re.findall(r"(-?\d+(?:\.\d+)?)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"cannot read interval {text!r}")
    total = dt.timedelta(0)
    for num, unit in parts:
        u = unit.lower().rstrip("s")
        if u not in _UNITS:
            raise ValueError(f"unknown interval unit {unit!r}")
        total += dt.timedelta(**{_UNITS[u]: float(num)})
    return total


def ts_lit(value: dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal (constant-folded, so it reaches the Parquet scan)."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.expr(f"TIMESTAMP_NTZ '{value}'")


def resolve_as_of(df: DataFrame, col: str = "timestamp") -> dt.datetime | None:
    """Default reference time: the latest timestamp in the data, never the clock.

    One scalar aggregate; on a plain Parquet scan it is answered from footers
    (``spark.sql.parquet.aggregatePushdown``).
    """
    return df.agg(F.max(col).alias("m")).first()["m"]


def now_utc() -> dt.datetime:
    """The driver's UTC wall clock as a naive datetime (for ``as_of="now"``)."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def as_of_value(as_of):
    """``"now"`` -> the UTC clock; anything else unchanged."""
    return now_utc() if isinstance(as_of, str) and as_of.lower() == "now" else as_of


def _cutoff(as_of: dt.datetime, lookback) -> dt.datetime:
    return as_of_value(as_of) - parse_interval(lookback)


def since(df: DataFrame, as_of: dt.datetime | None, lookback, col: str = "timestamp",
          date_col: str = "event_date") -> DataFrame:
    """Keep rows with ``col >= as_of - lookback`` (``NOW() - INTERVAL ..``).

    ``as_of`` is a datetime, ``None`` (the latest ``col`` in the data, so results
    repeat) or ``"now"`` (the UTC clock, read once on the driver, so the cut is
    still a constant that reaches the scan). When the table is partitioned by
    ``date_col`` the matching date predicate is added as well, so whole date
    directories are pruned, not only row groups. ``lookback=None`` keeps everything.
    """
    if lookback is None:
        return df
    as_of = as_of_value(as_of)
    if as_of is None:
        as_of = resolve_as_of(df, col)
        if as_of is None:
            return df
    cut = _cutoff(as_of, lookback)
    out = df.filter(F.col(col) >= ts_lit(cut))
    if date_col in df.columns:
        out = out.filter(F.col(date_col) >= F.lit(cut.date()))
    return out


def before(df: DataFrame, as_of: dt.datetime, age, col: str = "timestamp",
           date_col: str = "event_date") -> DataFrame:
    """Keep rows with ``col < as_of - age`` (the rows a retention delete removes)."""
    as_of = as_of_value(as_of)
    cut = _cutoff(as_of, age)
    out = df.filter(F.col(col) < ts_lit(cut))
    if date_col in df.columns:
        out = out.filter(F.col(date_col) <= F.lit(cut.date()))
    return out


def trunc_ntz(unit: str, col) -> Column:
    """DATE_TRUNC that keeps TIMESTAMP_NTZ (Spark's returns a zoned TIMESTAMP)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def epoch_seconds_between(start, end) -> Column:
    """EXTRACT(EPOCH FROM end - start) as DOUBLE seconds, microsecond exact."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("MICROSECOND", s, e) / F.lit(1_000_000.0)


# Fixed value of the reading validator: epoch numbers above this magnitude are
# milliseconds.
EPOCH_MS_THRESHOLD = 2e10


# The usual forms: a date and a time with 0, 3 or 6 fraction digits and an optional zone of Z or +HH:MM.
ISO_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{3}([0-9]{3})?)?)?(Z|[+-][0-9]{2}:[0-9]{2})?$"
# All forms: a date; then any one character and a time of hours, minutes or seconds; then an offset down to microseconds.
ISO_FORMS = (r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[\s\S]([0-9]{2})(?::([0-9]{2})(?::([0-9]{2})(?:\.([0-9]{3}(?:[0-9]{3})?))?)?)?"
             r"(?:([+-])([0-9]{2}):([0-9]{2})(?::([0-9]{2})(?:\.([0-9]{6}))?)?)?)?$")


def parse_event_time(numeric: Column, text: Column) -> Column:
    """Normalise a reading's time to TIMESTAMP_NTZ (UTC wall clock).

    ``numeric`` is the field when the JSON carried a number: epoch seconds, or
    milliseconds beyond 2e10. ``text`` is the field when it carried a string:
    ISO 8601, with ``Z``, an offset, or naive (taken as UTC). Bare years, bare
    times and zone names are no event times. Anything else is NULL, which the
    validator turns into a schema error.
    """
    secs = F.when(F.abs(numeric) > EPOCH_MS_THRESHOLD, numeric / 1000.0).otherwise(numeric)
    from_num = F.timestamp_micros(F.round(secs * 1_000_000).cast("long")).cast("timestamp_ntz")
    usual = text.try_cast("timestamp").cast("timestamp_ntz")
    # the rest is tried only where the usual forms fail
    from_text = F.coalesce(F.when(text.rlike(ISO_TIME) & (F.left(text, F.lit(4)) != "0000"), usual), _rare_iso_time(text))
    return F.when(numeric.isNotNull(), from_num).otherwise(from_text)


def _rare_iso_time(text: Column) -> Column:
    """The remaining ISO forms: other separators, hours only, offsets with seconds. ``Z`` stands for +00:00 anywhere."""
    zoned = F.replace(text, F.lit("Z"), F.lit("+00:00"))

    def part(n: int, default: str = "00") -> Column:
        got = F.regexp_extract(zoned, ISO_FORMS, n)
        return F.when(got == "", F.lit(default)).otherwise(got)
    wall = F.concat(part(1), F.lit(" "), part(2), F.lit(":"), part(3), F.lit(":"), part(4), F.lit("."), F.rpad(part(5, "0"), 6, "0"))
    sign = F.when(part(6, "+") == "-", -1).otherwise(1)
    seconds = part(7).cast("int") * 3600 + part(8).cast("int") * 60 + part(9).cast("int")
    offset = sign * (seconds.cast("long") * 1_000_000 + part(10, "0").cast("long"))
    at = wall.try_cast("timestamp_ntz")
    good = zoned.rlike(ISO_FORMS) & (F.left(zoned, F.lit(4)) != "0000") & (seconds < 86400)
    return F.when(good, F.timestamp_add("MICROSECOND", -offset, at))


__all__ = [
    "now_utc", "as_of_value", "parse_interval", "ts_lit", "resolve_as_of", "since", "before", "trunc_ntz",
    "epoch_seconds_between", "parse_event_time",
]
