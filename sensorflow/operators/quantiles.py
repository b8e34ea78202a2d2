"""Exact quantiles per group without gathering a group's values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.operators.joins import dim_join
from sensorflow.session import materialize

#: Groups of up to this many values are exact in one sketch of ten times the accuracy.
SKETCHED = 1000
#: Cells that a refinement pass cuts a group into, of about equal counts; more than ``SKETCHED``.
CELLS = 1024


def _same(keys, left: str, right: str) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return on


def rank_of(n: Column, q: float) -> Column:
    """The place (from 1) of the discrete quantile ``q`` among ``n`` values: the smallest whose share of values up to it reaches ``q``."""
    return F.greatest(F.lit(1), n - F.floor(n - F.lit(float(q)) * n)).cast("long")


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float, name: str, aggs: list[Column] = ()) -> DataFrame:
    """``keys``, ``aggs`` and the discrete quantile ``q`` of the finite doubles ``value`` as ``name``, per group.

    Every group is reduced once by partial aggregates, with a quantile sketch that
    is exact for up to ``SKETCHED`` values. Of a larger group the sketch gives two
    values that bracket the quantile; the rows below, at and between them are
    counted, which gives the quantile itself or the part that holds it and its
    rank there. Later passes bracket it by cells of that part, each some hundred
    times smaller, until a sketch is exact. A group of any size and distribution
    thus costs a few rows a task, and the counts decide, so the result does not
    rest on the sketch's error. Only rows still in question are read again, from a
    written table. NULL where a group has no value.
    """
    v = F.col(value)
    rows = df.withColumn(value, F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v))
    accuracy = 10 * SKETCHED
    around = [max(0.0, q - 2 / accuracy), float(q), min(1.0, q + 2 / accuracy)]
    one = materialize(rows.groupBy(*keys).agg(*aggs, F.count(value).alias("_n"), F.percentile_approx(value, around, accuracy).alias("_p")))
    kept = [c for c in one.columns if c not in ("_n", "_p")]
    sketch = one.select(*kept, F.col("_p")[1].alias(name))
    large = one.filter((F.col("_n") > SKETCHED) & (F.col("_p")[0] < F.col("_p")[2]))
    if large.isEmpty():
        return sketch
    ask = materialize(large.select(*keys, F.col("_p")[0].alias("_a"), F.col("_p")[2].alias("_b"), rank_of(F.col("_n"), q).alias("_rank"),
                                   F.col("_n")))
    values, done = rows.select(*keys, value).filter(F.col(value).isNotNull()), []
    while not ask.isEmpty():
        parts = materialize(_counted(values, ask, keys, value))
        done.append(parts.filter("_exact IS NOT NULL").select(*keys, "_exact"))
        open_ = parts.filter("_exact IS NULL")
        values = materialize(_of_groups(values, open_, keys, value).filter(
            (F.col("_lo").isNull() | (v > F.col("_lo"))) & (F.col("_hi").isNull() | (v < F.col("_hi")))).select(*keys, value))
        cells = _of_groups(values, open_, keys, value).groupBy(*keys, "_rank", "_n").agg(
            F.percentile_approx(value, [i / CELLS for i in range(CELLS + 1)], accuracy).alias("_c"))
        at = F.floor(F.col("_rank") * F.lit(CELLS) / F.col("_n")).cast("int")  # the cell of the rank, exactly so for few values
        cells = materialize(cells.select(*keys, "_rank", "_n", F.get("_c", at).alias("_exact"), F.get("_c", F.greatest(at - 1, F.lit(0))).alias("_a"),
                                         F.get("_c", F.least(at + 2, F.lit(CELLS))).alias("_b")))
        settled = (F.col("_n") <= SKETCHED) | (F.col("_a") == F.col("_b"))
        done.append(cells.filter(settled).select(*keys, "_exact"))
        ask = cells.filter(~settled).select(*keys, "_a", "_b", "_rank", "_n")
    exact = done[0]
    for part in done[1:]:
        exact = exact.unionByName(part)
    out = sketch.alias("o").join(exact.alias("d"), _same(keys, "o", "d"), "left")
    return out.select(*[F.col(f"o.{c}") for c in kept], F.coalesce(F.col("d._exact"), F.col(f"o.{name}")).alias(name))


def _of_groups(values: DataFrame, groups: DataFrame, keys, value: str) -> DataFrame:
    """The values with what ``groups`` says of theirs; a group here has over a thousand values, so its table is small."""
    rest = [c for c in groups.columns if c not in keys]
    j = dim_join(values.alias("v"), groups.alias("g"), _same(keys, "v", "g"), "inner")
    return j.select(*[F.col(f"v.{k}").alias(k) for k in keys], F.col(f"v.{value}").alias(value), *[F.col(f"g.{c}").alias(c) for c in rest])


def _counted(values: DataFrame, ask: DataFrame, keys, value: str) -> DataFrame:
    """Where the rank lies as to ``_a`` < ``_b``: the value ``_exact`` if it is one of them, else its rank among the ``_n``
    values between ``_lo`` and ``_hi`` (exclusive; NULL: open), which are those between, below or above."""
    v, a, b, rank = F.col(value), F.col("_a"), F.col("_b"), F.col("_rank")
    n = _of_groups(values, ask, keys, value).groupBy(*keys, "_a", "_b", "_rank").agg(
        F.count_if(v < a).alias("_below"), F.count_if(v <= a).alias("_upto_a"), F.count_if(v < b).alias("_upto"), F.count_if(v <= b).alias("_upto_b"),
        F.count(F.lit(1)).alias("_all"))
    below, upto_a, upto, upto_b = (F.col(c) for c in ("_below", "_upto_a", "_upto", "_upto_b"))
    under, over = rank <= below, rank > upto_b
    between = (rank > upto_a) & (rank <= upto)
    return n.select(
        *keys, F.when(between | under | over, F.lit(None)).when(rank <= upto_a, a).otherwise(b).alias("_exact"),
        F.when(between, a).when(over, b).alias("_lo"), F.when(between, b).when(under, a).alias("_hi"),
        F.when(between, rank - upto_a).when(over, rank - upto_b).otherwise(rank).alias("_rank"),
        F.when(between, upto - upto_a).when(under, below).otherwise(F.col("_all") - upto_b).alias("_n"))


__all__ = ["exact_quantile", "rank_of"]
