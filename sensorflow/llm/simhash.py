"""SimHash near-duplicates found by multi-index hashing.

Every text gets a 64-bit fingerprint of its word shingles. Two fingerprints are linked if they differ in at
most ``max_bits`` bits, and every row returns the smallest id it can reach over links.

*Multi-index hashing.* The 64 bits are cut into two segments of 32. If two fingerprints differ in at most four
bits, then either the low halves differ in at most two bits or the high halves in at most one (three or more
plus two or more would be five). Distance two between halves is met in the middle: both sides enumerate the
Hamming ball of radius one (33 keys) and some key is shared. So every fingerprint writes 33 keys per segment,
equal keys are fetched by an equi-join, and the complete distance of each fetched pair is verified.

*Scale.* Rows of equal text or equal fingerprint are one fingerprint before any key is written. Components are
first joined cheaply: fingerprints sorted in several bit rotations, each verified against its neighbours.
Keys all of whose fingerprints are then in one component are dropped before pairs are fetched (they can add no
link between components), so a dense group of near copies does not meet itself pair by pair; the remaining
pairs are fetched only across components. The result is exact: the links that are never fetched join
fingerprints that are joined already. Nothing is collected to the driver and nothing is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm.common import col, fresh, id_type, map_texts, only_rows, pick, staged, text_key
from sensorflow.llm.components import connected_components

SEED = 42


def fingerprint(text: str | None, shingle: int = 4, lower: bool = True) -> int:
    """The 64-bit fingerprint: bit b is set if over half of the shingles' XXH64 (seed 42) have it set.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; fewer words than ``shingle`` make one shingle;
    no words (null, empty or blank text) give zero.
    """
    import numpy as np
    from xxhash import xxh64_intdigest as h

    data = text.encode("utf-8", "surrogatepass") if text else b""
    words = (data.lower() if lower else data).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return h(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words))) + np.arange(len(words))
    starts = np.empty(len(words), dtype=np.int64)
    starts[0], starts[1:] = 0, ends[:-1] + 1
    hashes = np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())),
                         dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 4096):  # bounded memory for very long texts
        part = hashes[at:at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``id, key, fp`` (content key; fingerprint as a signed long), one row per row of ``df``."""
    def step(batch: dict) -> dict:
        fps = [fingerprint(t, shingle) for t in batch["text"]]
        return {"id": batch["id"], "key": [text_key(t) for t in batch["text"]],
                "fp": [f - (1 << 64) if f >= 1 << 63 else f for f in fps]}

    rows = pick(df, id=id_col, text=text_col)
    return map_texts(rows, step, f"id {id_type(rows)}, key bigint, fp bigint")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _neighbour_links(fps: DataFrame, max_bits: int, rotations: int) -> DataFrame:
    """Links between neighbours in sorted order under several bit rotations: linear work, no link invented.

    The sort is cut into blocks by the leading 16 bits of the rotated value, so no task sees all fingerprints.
    """
    step = 64 // rotations
    rot = F.array(*[F.shiftleft("fp", k * step).bitwiseOR(F.shiftrightunsigned("fp", 64 - k * step)) if k else F.col("fp")
                    for k in range(rotations)])
    keyed = fps.select("fp", F.posexplode(rot).alias("turn", "value"))
    w = Window.partitionBy("turn", F.shiftrightunsigned("value", 48)).orderBy("value")
    near = keyed.select("fp", F.lag("fp").over(w).alias("other"))
    return near.filter(F.col("other").isNotNull() & (_distance(F.col("fp"), F.col("other")) <= max_bits)) \
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))


def _ball_keys(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fp, comp, seg, key``: the radius-one (or -zero) balls of both halves that ``max_bits`` asks for."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    # The low half may differ in r_low bits, the high half in r_high, with r_low + r_high + 2 > max_bits.
    r_low, r_high = (max_bits - 1) - (max_bits - 1) // 2, (max_bits - 1) // 2
    if max_bits > 5 or max_bits < 1:
        raise ValueError("max_bits is 1 to 5: two balls of radius one meet at distance two in each 32-bit half")

    def ball(half: Column, radius: int) -> Column:
        flips = [half] + ([half.bitwiseXOR(F.lit(1 << k)) for k in range(32)] if radius else [])
        return F.array(*flips)

    seg = F.array(*[F.struct(F.lit(s).alias("seg"), ball(half, r).alias("keys"))
                    for s, half, r in ((0, low, r_low), (1, high, r_high))])
    return fps.select("fp", "comp", F.explode(seg).alias("s")) \
        .select("fp", "comp", F.col("s.seg").alias("seg"), F.explode("s.keys").alias("key"))


def link_fingerprints(fps: DataFrame, max_bits: int = 4, rotations: int = 4) -> DataFrame:
    """``fp, comp`` for distinct fingerprints ``fp``: comp is the smallest fingerprint reachable over links."""
    near = _neighbour_links(fps, max_bits, rotations)
    first = staged(connected_components(fps.select(F.col("fp").alias("node")), near), "simhash-first") \
        .select(F.col("node").alias("fp"), "comp")

    # Fingerprints are few bytes, their keys 66 times as many rows: spread them first, then deal the keys once,
    # for the grouping and the semi-join alike.
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = _ball_keys(first.repartition(n, "fp"), max_bits).repartition(n, "seg", "key")
    # Only keys that two components share can add a link.
    shared = keys.groupBy("seg", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")) \
        .filter("lo < hi").select("seg", "key")
    live = staged(keys.join(shared, ["seg", "key"], "left_semi"), "simhash-keys")
    a, b = live.alias("a"), live.alias("b")
    links = a.join(b, (F.col("a.seg") == F.col("b.seg")) & (F.col("a.key") == F.col("b.key"))
                   & (F.col("a.comp") < F.col("b.comp"))
                   & (_distance(F.col("a.fp"), F.col("b.fp")) <= max_bits)) \
        .select(F.col("a.comp").alias("a"), F.col("b.comp").alias("b")).distinct()
    merged = connected_components(first.select(F.col("comp").alias("node")).distinct(), links)
    return first.join(merged.withColumnRenamed("comp", "root"), first["comp"] == F.col("node")) \
        .select("fp", F.col("root").alias("comp"))


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       max_bits: int = 4, rotations: int = 4) -> DataFrame:
    """``id, key, fp, comp, component_id``, one row per row of ``df``; ``comp`` is the component's smallest fingerprint.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Repeated ids and repeated
    rows keep a row each. ``component_id`` is the smallest non-null id in the component (null if all are null).
    An empty table gives an empty result. Extra columns are ignored.
    """
    rows = staged(fingerprints(df, id_col, text_col, shingle), "simhash-rows")
    per_fp = staged(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-fps")
    linked = link_fingerprints(per_fp.select("fp"), max_bits, rotations)
    comp = per_fp.join(linked, "fp")
    smallest = comp.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    table = comp.join(smallest, "comp").select("fp", "comp", "component_id")
    return rows.join(table, "fp").select("id", "key", "fp", "comp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``df`` with one row of each component: the one of the smallest id, then content key (null ids last).

    All columns stay as they are; of rows equal in id and text one stays.
    """
    found = simhash_components(df, id_col, text_col, shingle, max_bits)
    first = found.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("r")).select("r.id", "r.key")
    turn, = fresh(df, "turn")
    kept = only_rows(df, first, "left_semi", id_col, text_col)
    w = Window.partitionBy(col(id_col), F.xxhash64(col(text_col))).orderBy(F.lit(0))
    return kept.withColumn(turn, F.row_number().over(w)).filter(col(turn) == 1).drop(turn)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
