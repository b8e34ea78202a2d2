"""Time-series operators: latest value, neighbours (LAG/LEAD), anomalies, gaps,
correlation, moving averages, resampling and feature tables.

Scale notes:
* Neighbour lookups never window over a whole sensor. Rows are split into
  (sensor, time slice) groups, LAG/LEAD run inside each slice, and the row
  beside a slice's edge is added to it from a small per-slice summary. A sensor
  holding a third of all rows, or bursts of them, is therefore spread over as
  many tasks as it has slices.
* Per-sensor statistics (z-score) are written to the shared checkpoint folder
  once and broadcast back behind a row bound.
* Correlation pre-aggregates (time key, sensor) and sums the products of pairs
  as matrix products of sensor blocks over chunks of time keys; no rows are
  joined and no pair is shuffled per time key.
* Feature windows run in time slices led by a halo of the rows they look back to.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow import schemas as S
from sensorflow.functions.numeric import corr_from_moments
from sensorflow.functions.time import as_of_value, epoch_seconds_between, parse_interval, since, trunc_ntz, ts_lit
from sensorflow.operators.joins import dim_join
from sensorflow.session import materialize

EPOCH = "1970-01-01 00:00:00"


def _quality(m: DataFrame, quality: str | None) -> DataFrame:
    return m if quality is None else m.filter(F.col("quality_flag") == quality)


def _slice_of(col: str, split) -> Column:
    us = int(parse_interval(split).total_seconds() * 1_000_000)
    return F.floor(F.timestamp_diff("MICROSECOND", ts_lit(EPOCH), F.col(col)) / F.lit(us)).cast("long")


# ------------------------------------------------------------------ Q2 (W5)

def latest_reading(m: DataFrame, key: str = "sensor_id", ordered: bool = True) -> DataFrame:
    """Latest reading per sensor (ties on time broken by the higher id), ordered
    by sensor like the original (the sort covers one row per sensor).

    ``max_by`` is a partial aggregate: each task keeps one candidate per
    sensor before the shuffle.
    """
    best = F.max_by(F.struct("timestamp", "value", "quality_flag"), F.struct("timestamp", "id"))
    out = (m.groupBy(key).agg(best.alias("_r"))
            .select(key, "_r.timestamp", "_r.value", "_r.quality_flag"))
    return out.orderBy(key) if ordered else out


# ------------------------------------------------------------------ W1 / W2

# Rows one window task should hold for a single sensor slice.
SLICE_TARGET_ROWS = 2_000_000


def _micros(ts: str) -> Column:
    return F.timestamp_diff("MICROSECOND", ts_lit(EPOCH), F.col(ts))


def _auto_slices(df: DataFrame, key: str, ts: str, target_rows: int) -> DataFrame:
    """``df`` with ``_slice``, the start (microseconds) of each row's time slice.

    A key's span is first cut evenly at its average rate, so a quiet key is one
    slice. Slices that still hold over twice ``target_rows`` rows (bursts) are
    counted and cut again by their own rate until none is left, or their rows
    share one microsecond. Each round is one partial aggregate whose result, the
    hot slices, is kept in the shared folder.
    """
    us = _micros(ts)
    st = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(us).alias("_lo"), (F.max(us) - F.min(us) + 1).alias("_span"))
    even = F.greatest(F.lit(1), F.ceil(F.col("_span") * (F.lit(float(target_rows)) / F.col("_n"))))
    length = F.when(F.col("_n") <= target_rows, F.col("_span")).otherwise(even).cast("long")
    lengths = materialize(st.select(F.col(key).alias("_sk"), "_lo", length.alias("_len")))
    d = dim_join(df, lengths, F.col(key).eqNullSafe(F.col("_sk")), "left")
    d = d.withColumn("_slice", us - F.pmod(us - F.col("_lo"), F.col("_len"))).drop("_sk", "_lo")
    while True:
        hot = d.groupBy(key, "_slice", "_len").agg(F.count(F.lit(1)).alias("_n")) \
            .filter((F.col("_n") > 2 * target_rows) & (F.col("_len") > 1))
        finer = F.ceil(F.col("_len") / F.ceil(F.col("_n") / F.lit(target_rows))).cast("long")
        hot = materialize(hot.select(F.col(key).alias("_sk"), F.col("_slice").alias("_lo"), finer.alias("_finer")))
        if hot.isEmpty():
            return d.drop("_len")
        d = dim_join(d, hot, F.col(key).eqNullSafe(F.col("_sk")) & (F.col("_slice") == F.col("_lo")), "left")
        d = d.withColumns({"_slice": F.coalesce(us - F.pmod(us - F.col("_lo"), F.col("_finer")), F.col("_slice")),
                           "_len": F.coalesce("_finer", "_len")}).drop("_sk", "_lo", "_finer")


def with_neighbor(df: DataFrame, cols, direction: str = "prev", key: str = "sensor_id",
                  order=("timestamp", "id"), split="auto", prefix: str | None = None,
                  target_rows: int = SLICE_TARGET_ROWS) -> DataFrame:
    """Add LAG (``prev``) or LEAD (``next``) of ``cols`` per ``key`` ordered by ``order``.

    Equal to ``lag/lead(c).over(Window.partitionBy(key).orderBy(*order))`` but
    computed per (key, time slice). ``split`` is a fixed slice length ('1 day')
    or ``'auto'``: slices sized to ``target_rows`` rows.

    The row next to a slice's edge, in the neighbouring non-empty slice, comes
    from a partial ``max_by``/``min_by`` aggregate (one row per slice) and enters
    the slice as an extra row that the window sees and the result leaves out. So
    the fact is shuffled and sorted once, and never joined.
    """
    cols = list(cols)
    order = list(order)
    prefix = prefix or ("prev_" if direction == "prev" else "next_")
    fn, edge, step = (F.lag, F.max_by, F.lead) if direction == "prev" else (F.lead, F.min_by, F.lag)
    d = _auto_slices(df, key, order[0], target_rows) if split == "auto" else df.withColumn("_slice", _slice_of(order[0], split))
    need = list(dict.fromkeys(order + cols))
    edges = d.groupBy(key, "_slice").agg(edge(F.struct(*need), F.struct(*order)).alias("_e"))
    # the slice that needs this edge; a struct, so that a slice of null times is told from none
    to = step(F.struct("_slice")).over(Window.partitionBy(key).orderBy("_slice"))
    carry = edges.select(key, to.alias("_to"), "_e").filter(F.col("_to").isNotNull()) \
        .select(key, F.col("_to._slice").alias("_slice"), *[F.col(f"_e.{c}").alias(c) for c in need if c != key],
                F.lit(True).alias("_carried"))
    every = d.withColumn("_carried", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(key, "_slice").orderBy(*order)
    return every.withColumns({prefix + c: fn(F.col(c)).over(w) for c in cols}).filter(~F.col("_carried")) \
        .select(*df.columns, *[prefix + c for c in cols])


# ------------------------------------------------------------------ Q8 / M7

def sensor_stats(m: DataFrame, as_of, lookback="7 days", quality: str | None = S.FLAG_VALID) -> DataFrame:
    f = _quality(since(m, as_of, lookback), quality)
    return f.groupBy("sensor_id").agg(F.avg("value").alias("mean_value"),
                                      F.stddev_samp("value").alias("std_dev"))


def zscore_anomalies(m: DataFrame, as_of: dt.datetime | None = None, lookback="7 days", k: float = 3.0,
                     limit: int | None = 20, quality: str | None = S.FLAG_VALID) -> DataFrame:
    """Readings more than ``k`` sample deviations from their sensor's mean.

    Statistics come from ``quality`` rows only, while every row in the window
    is scored. ``z_score`` is NULL-safe (``try_divide``). Top ``limit`` by
    z-score (ties by id); ``limit=None`` returns all.
    """
    stats = materialize(sensor_stats(m, as_of, lookback, quality))
    f = since(m, as_of, lookback)
    j = dim_join(f, stats, "sensor_id", "inner")
    dev = F.abs(F.col("value") - F.col("mean_value"))
    out = (j.filter(dev > F.lit(k) * F.col("std_dev"))
            .select("sensor_id", "timestamp", "value", "mean_value", "std_dev",
                    F.try_divide(dev, F.col("std_dev")).alias("z_score"), "id"))
    out = out.orderBy(F.col("z_score").desc(), "id")
    if limit is not None:
        out = out.limit(limit)
    return out.drop("id")


# ------------------------------------------------------------------ Q9

def rate_of_change(m: DataFrame, as_of: dt.datetime | None = None, lookback="1 hour",
                   min_change: float = 0.5, limit: int | None = 20,
                   quality: str | None = S.FLAG_VALID, split="auto") -> DataFrame:
    """Largest value jumps between consecutive readings of a sensor."""
    f = _quality(since(m, as_of, lookback), quality).select("id", "sensor_id", "timestamp", "value")
    n = with_neighbor(f, ["value", "timestamp"], "prev", split=split)
    change = F.col("value") - F.col("prev_value")
    secs = epoch_seconds_between("prev_timestamp", "timestamp")
    out = (n.filter(F.col("prev_value").isNotNull() & (F.abs(change) > F.lit(min_change)))
            .select("sensor_id", "timestamp", "value", "prev_value", change.alias("change"),
                    secs.alias("seconds_elapsed"), F.try_divide(change, secs).alias("rate_per_second"),
                    "id"))
    out = out.orderBy(F.abs(F.col("change")).desc(), "id")
    if limit is not None:
        out = out.limit(limit)
    return out.drop("id")


# ------------------------------------------------------------------ Q10

def data_gaps(m: DataFrame, as_of: dt.datetime | None = None, lookback="1 hour", min_gap_s: float = 5.0,
              close_tail: bool = False, split="auto") -> DataFrame:
    """Silences longer than ``min_gap_s`` between consecutive readings.

    By default only gaps between two readings are seen; ``close_tail=True``
    also reports the silence from a sensor's last reading up to ``as_of``.
    """
    as_of = as_of_value(as_of)
    f = since(m, as_of, lookback).select("id", "sensor_id", "timestamp")
    n = with_neighbor(f, ["timestamp"], "next", split=split)
    end = F.col("next_timestamp")
    if close_tail:
        if as_of is None:
            from sensorflow.functions.time import resolve_as_of
            as_of = resolve_as_of(m)
        end = F.coalesce(end, ts_lit(as_of))
    gap = epoch_seconds_between("timestamp", end)
    out = (n.select("sensor_id", F.col("timestamp").alias("gap_start"), end.alias("gap_end"),
                    gap.alias("gap_seconds"))
            .filter(F.col("gap_seconds") > F.lit(float(min_gap_s))))
    return out.orderBy(F.col("gap_seconds").desc(), "sensor_id", "gap_start")


# ------------------------------------------------------------------ Q11

#: Sensors of a block and rows of a group in the blocked correlation: bounds of one task's matrices.
BLOCK_SENSORS, GROUP_ROWS = 256, 400_000
#: Shared time keys of one matrix product.
SLAB = 1024


def sensor_correlation(m: DataFrame, as_of: dt.datetime | None = None, lookback="24 hours",
                       bucket: str | None = None, min_n: int = 100,
                       quality: str | None = S.FLAG_VALID, blocks: int | None = None, peers: DataFrame | None = None) -> DataFrame:
    """Pearson correlation of every sensor pair over shared time keys.

    ``bucket=None`` pairs readings with equal timestamps, exactly as a self-join
    would (duplicates multiply); with a bucket ('1 hour') each sensor's bucket
    mean is paired. Either way each (time key, sensor) is first reduced to
    count / sum / sum of squares, and the pair sums are rebuilt from those
    moments. Pairs with ``sample_size <= min_n`` are dropped; NULL correlation
    when a side is constant.

    No rows are joined. Sensors are hashed into ``blocks`` blocks and time keys
    into chunks; the rows of two blocks in one chunk meet in one group, where the
    sums of all their pairs are six matrix products over the chunk's shared time
    keys. Each row is sent once per block, and a group returns one row per pair
    that shares a key, so what is shuffled grows with the readings and not with
    the pairs of every time key; counts are exact. Blocks hold about
    ``BLOCK_SENSORS`` sensors and groups about ``GROUP_ROWS`` rows, which bounds a
    task's memory. ``peers`` (sensor_id, peer_group) pairs only sensors of one
    group, such as a location; sensors without a group are left out.
    """
    f = _quality(since(m, as_of, lookback), quality).select("timestamp", "sensor_id", "value")
    if bucket is not None:
        f = f.groupBy(F.window("timestamp", bucket).start.alias("timestamp"), "sensor_id").agg(F.avg("value").alias("value"))
    f = materialize(f.filter("value is not null and sensor_id is not null and timestamp is not null"))
    # Moments are taken about each sensor's mean, so that a large offset does not
    # cancel; a constant sensor deviates by exactly 0.
    level = f.groupBy("sensor_id").agg(F.avg("value").alias("_mean"), F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    dev = F.when(F.col("_lo") == F.col("_hi"), F.lit(0.0)).otherwise(F.col("value") - F.col("_mean"))
    g = f.join(level, "sensor_id").groupBy(F.col("timestamp").alias("_tk"), "sensor_id").agg(
        F.count(F.lit(1)).cast("double").alias("c"), F.sum(dev).alias("s"), F.sum(dev * dev).alias("ss"))
    if peers is not None:
        g = dim_join(g, peers.select("sensor_id", F.col("peer_group").cast("string").alias("peer_group")), "sensor_id", "inner")
    else:
        g = g.withColumn("peer_group", F.lit(""))
    g = materialize(g)
    rows, sensors = g.agg(F.count(F.lit(1)), F.approx_count_distinct("sensor_id")).first()
    blocks = blocks or max(1, -(-sensors // BLOCK_SENSORS))
    chunks = max(1, -(-2 * rows // (blocks * GROUP_ROWS)))
    own = F.pmod(F.xxhash64("sensor_id"), F.lit(blocks)).cast("int")
    to = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    dealt = g.select(F.pmod(F.xxhash64("_tk", F.lit(7)), F.lit(chunks)).alias("_chunk"), own.alias("_own"), to.alias("_to"), "peer_group",
                     F.unix_micros(F.col("_tk").cast("timestamp")).alias("_tk"), "sensor_id", "c", "s", "ss")
    dealt = dealt.withColumns({"_i": F.least("_own", "_to"), "_j": F.greatest("_own", "_to")})
    sums = dealt.groupBy("peer_group", "_chunk", "_i", "_j").applyInArrow(_pair_sums(SLAB), PAIR_SUMS) \
        .groupBy("sensor_1", "sensor_2").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    out = sums.filter(F.col("n") > min_n).select(
        "sensor_1", "sensor_2",
        corr_from_moments("n", "sx", "sy", "sxx", "syy", "sxy").alias("correlation"),
        F.col("n").cast("long").alias("sample_size"))
    return out.orderBy(F.col("correlation").desc_nulls_last(), "sensor_1", "sensor_2")


PAIR_SUMS = "sensor_1 string, sensor_2 string, n double, sx double, sy double, sxx double, syy double, sxy double"


def _pair_sums(slab_keys: int):
    """A function of one group's rows, self-contained so that workers need not import this package."""
    def sums_of(rows):
        """Moments of all sensor pairs of two blocks over the time keys they share in one chunk."""
        import numpy as np
        import pyarrow as pa

        names = rows.column("sensor_id").combine_chunks().dictionary_encode()
        sensor, names = np.asarray(names.indices), names.dictionary
        own, (i, j) = np.asarray(rows.column("_own")), (rows.column(c)[0].as_py() for c in ("_i", "_j"))
        keys, key = np.unique(np.asarray(rows.column("_tk")), return_inverse=True)
        values = np.stack([np.asarray(rows.column(c)) for c in ("c", "s", "ss")])
        sides = []  # per side: its sensors, and its rows by time key
        for block in (i, j):
            at = np.flatnonzero(own == block)
            mine, local = np.unique(sensor[at], return_inverse=True)
            sides.append((mine, key[at], local, values[:, at]))
        (mine_a, key_a, at_a, v_a), (mine_b, key_b, at_b, v_b) = sides
        shared = np.intersect1d(key_a, key_b)
        sums = np.zeros((6, len(mine_a), len(mine_b)))
        for start in range(0, len(shared), slab_keys):
            slab = shared[start:start + slab_keys]
            dense = []
            for k, at, v, width in ((key_a, at_a, v_a, len(mine_a)), (key_b, at_b, v_b, len(mine_b))):
                place = np.minimum(np.searchsorted(slab, k), len(slab) - 1)
                hit = slab[place] == k
                x = np.zeros((3, len(slab), width))
                x[:, place[hit], at[hit]] = v[:, hit]  # one row per (time key, sensor)
                dense.append(x)
            (c1, s1, q1), (c2, s2, q2) = dense
            for to, (x, y) in enumerate(((c1, c2), (s1, c2), (c1, s2), (q1, c2), (c1, q2), (s1, s2))):
                sums[to] += x.T @ y
        names = np.asarray(names.to_pylist(), dtype=object)
        one, two = np.meshgrid(names[mine_a], names[mine_b], indexing="ij")
        less = one < two  # strings by code point
        take = (sums[0] > 0) & (less if i == j else one != two)
        swap = ~less[take]
        n, sx, sy, sxx, syy, sxy = (x[take] for x in sums)
        one, two = one[take], two[take]
        return pa.table({"sensor_1": pa.array(np.where(swap, two, one), pa.string()), "sensor_2": pa.array(np.where(swap, one, two), pa.string()),
                         "n": n, "sx": np.where(swap, sy, sx), "sy": np.where(swap, sx, sy), "sxx": np.where(swap, syy, sxx),
                         "syy": np.where(swap, sxx, syy), "sxy": sxy})

    return sums_of


# ------------------------------------------------------------------ Q12

def moving_average(m: DataFrame, as_of: dt.datetime | None = None, lookback="30 days", rows: int = 7,
                   quality: str | None = S.FLAG_VALID, frame: str = "rows") -> DataFrame:
    """Daily mean and its moving mean over the last ``rows`` days.

    ``frame='rows'`` counts non-empty days (a missing day stretches the
    window); ``frame='range'`` counts calendar days. The window runs over the
    per-day table, at most one row per sensor and day.
    """
    f = _quality(since(m, as_of, lookback), quality)
    daily = f.groupBy("sensor_id", trunc_ntz("day", "timestamp").alias("day")).agg(
        F.avg("value").alias("daily_avg"))
    if frame == "rows":
        w = Window.partitionBy("sensor_id").orderBy("day").rowsBetween(-(rows - 1), 0)
    else:
        daily = daily.withColumn("_dn", F.datediff(F.col("day").cast("date"), F.lit(dt.date(1970, 1, 1))))
        w = Window.partitionBy("sensor_id").orderBy("_dn").rangeBetween(-(rows - 1), 0)
    out = daily.select("sensor_id", "day", "daily_avg", F.avg("daily_avg").over(w).alias("moving_avg_7day"))
    return out.orderBy("sensor_id", F.col("day").desc())


# ------------------------------------------------------------------ M13 / T5 (batch)

def resample(m: DataFrame, every: str = "1 minute", quality: str | None = None,
             as_of: dt.datetime | None = None, lookback=None) -> DataFrame:
    """Tumbling-window rollup: (sensor_id, timestamp=window start, avg/min/max/count)."""
    f = _quality(since(m, as_of, lookback), quality)
    out = f.groupBy("sensor_id", F.window("timestamp", every).start.alias("timestamp")).agg(
        F.avg("value").alias("avg_value"), F.min("value").alias("min_value"),
        F.max("value").alias("max_value"), F.count(F.lit(1)).alias("sample_count"))
    return out


# ------------------------------------------------------------------ M12

def with_halo(df: DataFrame, rows_before: int, key: str = "sensor_id", order=("timestamp",), split="auto",
              target_rows: int = SLICE_TARGET_ROWS) -> DataFrame:
    """``df`` cut into slices of time per ``key`` (``_slice``), each led by the ``rows_before`` rows before it (``_carried``).

    Lags and row frames of up to so many rows, computed per (key, slice) in
    ``order``, then equal those over the whole key; drop the carried rows after.
    The last rows of each slice are kept per task before they are shuffled
    (window group limit). As a slice may hold fewer rows than are carried, these
    last rows are numbered along the key, and each slice takes those numbered
    before its own first.
    """
    order = list(order)
    d = _auto_slices(df, key, order[0], target_rows) if split == "auto" else df.withColumn("_slice", _slice_of(order[0], split))
    last = Window.partitionBy(key, "_slice").orderBy(*[F.col(c).desc() for c in order])
    tails = d.withColumn("_back", F.row_number().over(last)).filter(F.col("_back") <= rows_before).drop("_back")
    tails = materialize(tails.withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy(*order))))
    firsts = tails.groupBy(key, "_slice").agg(F.min("_place").alias("_first"))
    back = F.sequence(F.greatest(F.col("_first") - rows_before, F.lit(1)), F.col("_first") - 1)
    wanted = firsts.filter(F.col("_first") > 1).select(F.col(key).alias("_key"), F.col("_slice").alias("_to"), F.explode(back).alias("_at"))
    carry = tails.join(wanted, tails[key].eqNullSafe(F.col("_key")) & (F.col("_place") == F.col("_at"))) \
        .drop("_slice", "_place", "_at", "_key").withColumnRenamed("_to", "_slice").withColumn("_carried", F.lit(True))
    return d.withColumn("_carried", F.lit(False)).unionByName(carry)


def feature_table(m: DataFrame, every: str = "1 hour", lags=(1, 2, 3), rows: int = 24,
                  quality: str | None = S.FLAG_VALID, split="auto", target_rows: int = SLICE_TARGET_ROWS) -> DataFrame:
    """ML-ready features over the resampled series: lags, rolling mean/sd, rate, z.

    The resampled rows, kept in the shared folder, are cut into time slices with
    a halo of the rows that lags and frames look back to, so a sensor with a long
    history at a fine ``every`` is spread over several tasks.
    """
    r = materialize(resample(m, every, quality))
    d = with_halo(r, max([rows - 1, 1, *lags]), split=split, target_rows=target_rows)
    w = Window.partitionBy("sensor_id", "_slice").orderBy("timestamp")
    roll = w.rowsBetween(-(rows - 1), 0)
    before = {"_value": F.lag("avg_value", 1).over(w), "_time": F.lag("timestamp", 1).over(w)}
    out = d.withColumns({**{f"lag_{k}": F.lag("avg_value", k).over(w) for k in lags}, "rolling_mean": F.avg("avg_value").over(roll),
                         "rolling_std": F.stddev_samp("avg_value").over(roll), **before}).filter(~F.col("_carried"))
    rate = F.try_divide(F.col("avg_value") - F.col("_value"), epoch_seconds_between("_time", "timestamp"))
    return out.select(*r.columns, *[f"lag_{k}" for k in lags], "rolling_mean", "rolling_std", rate.alias("rate_per_second"),
                      F.try_divide(F.col("avg_value") - F.col("rolling_mean"), F.col("rolling_std")).alias("z_score"))


__all__ = [
    "latest_reading", "with_neighbor", "sensor_stats", "zscore_anomalies", "rate_of_change",
    "data_gaps", "sensor_correlation", "moving_average", "resample", "with_halo", "feature_table",
]
