"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows lie in source partitions of n_i rows; shard j is to get m_j rows, sizes at most one apart. In a uniform
random shuffle the number of rows that partition i sends to shard j follows the multivariate hypergeometric
law given those margins, so the matrix of all counts is drawn first, row by row, exactly. Then partition i
permutes its rows at random and sends the first a_i0 to shard 0, the next a_i1 to shard 1 and so on; the rows
are exchanged, and each shard permutes what it got once more.

*Scale.* The matrix has at most ``max_parts`` x ``shards`` counts and is the only thing on the driver. A source
partition is a scan split (folded to ``max_parts``), so equal rows don't gather. The second permutation deals
a shard's rows to ``buckets`` by their random key and numbers each bucket on its own; the offsets of
shards x buckets are a table of bounded size. No task holds a shard.

*Recovery.* The split and random key of each row are written to the shared folder first; a row computed again
after a lost executor meets the same matrix.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm.common import col, fresh, staged

MAX_PARTS, BUCKETS = 4096, 512


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows, drawn without replacement from good + bad, are good.

    Few draws are made one by one. Else the count is drawn by rejection under a ratio-of-uniforms hat
    (Stadlober 1990), in constant time for any size.
    """
    total = good + bad
    if draws > total - draws:  # draw those that are left out
        return good - hypergeometric(rng, good, bad, total - draws)
    if draws <= 12 or not good or not bad:
        got = 0
        for k in range(draws if good and bad else 0):
            got += rng.random() * (total - k) < good - got
        return got if good and bad else (draws if good else 0)
    if good > bad:
        return draws - hypergeometric(rng, bad, good, draws)
    share = good / total
    centre = draws * share + 0.5
    sd = math.sqrt((total - draws) * draws * share * (1 - share) / (total - 1) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * sd + 3 - 2 * math.sqrt(3 / math.e)
    mode = (draws + 1) * (good + 1) // (total + 2)

    def log_p(k: int) -> float:
        return -(math.lgamma(k + 1) + math.lgamma(good - k + 1) + math.lgamma(draws - k + 1) + math.lgamma(bad - draws + k + 1))

    top, last = log_p(mode), min(draws, good)
    while True:
        u = 1.0 - rng.random()
        x = centre + width * (rng.random() - 0.5) / u
        if x < 0 or x >= last + 1:
            continue
        k = int(x)
        if 2 * math.log(u) <= log_p(k) - top:
            return k


def communication_matrix(sizes: list[int], quotas: list[int], seed: int) -> list[list[int]]:
    """Rows per (partition, shard) with these exact margins, drawn with the law of a uniform shuffle."""
    rng, left, out = random.Random(seed), list(quotas), []
    for n in sizes:
        row, rest = [], sum(left)
        for j, m in enumerate(left):
            rest -= m
            k = hypergeometric(rng, m, rest, n)
            row.append(k)
            n -= k
            left[j] -= k
        out.append(row)
    return out


def quotas(n: int, shards: int) -> list[int]:
    return [n // shards + (j < n % shards) for j in range(shards)]


def hypergeometric_shuffle(df: DataFrame, shards: int = 8, seed: int = 42, shard_col: str = "shard", slot_col: str = "slot",
                           max_parts: int = MAX_PARTS, buckets: int = BUCKETS) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (int, 0 to shards - 1) and ``slot`` (long, gapless from 0).

    Shard sizes are at most one apart. Equal and null rows are rows like any other; an empty table gives an
    empty result. A column of the name of ``shard_col`` or ``slot_col`` is replaced; others can't clash.
    """
    df = df.drop(shard_col, slot_col)
    row, part, key, place, ends, bucket = fresh(df, "row", "part", "key", "place", "ends", "bucket")
    rows = staged(df.withColumn(row, F.monotonically_increasing_id())
                  .withColumn(part, F.pmod(F.spark_partition_id(), F.lit(max_parts)))
                  .withColumn(key, F.xxhash64(F.lit(seed), col(row))), "shuffle-rows")
    sizes = sorted((r[0], r[1]) for r in rows.groupBy(part).count().collect())  # at most max_parts
    matrix = communication_matrix([n for _, n in sizes], quotas(sum(n for _, n in sizes), shards), seed)
    upto = [(p, [sum(m[:j + 1]) for j in range(shards)]) for (p, _), m in zip(sizes, matrix)]
    bounds = df.sparkSession.createDataFrame(upto, f"`{part}` int, `{ends}` array<bigint>")
    # permute locally: the order of random keys; at most max_parts x shards numbers are broadcast
    sent = rows.withColumn(place, F.row_number().over(Window.partitionBy(part).orderBy(key, row))) \
        .join(F.broadcast(bounds), part) \
        .withColumn(shard_col, F.size(F.filter(col(ends), lambda e: e < col(place))).cast("int")) \
        .withColumn(key, F.xxhash64(F.lit(seed + 1), col(row))) \
        .withColumn(bucket, F.pmod(col(key), F.lit(buckets))) \
        .drop(part, place, ends)
    dealt = staged(sent, "shuffle-dealt")  # the exchange
    per = dealt.groupBy(shard_col, bucket).count()
    before = Window.partitionBy(shard_col).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(shard_col, bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(place))
    within = F.row_number().over(Window.partitionBy(shard_col, bucket).orderBy(key, row))
    return dealt.withColumn(slot_col, within) \
        .join(F.broadcast(offsets), [shard_col, bucket]) \
        .withColumn(slot_col, (col(place) + col(slot_col) - 1).cast("bigint")) \
        .select(*[col(c) for c in df.columns], shard_col, slot_col)
