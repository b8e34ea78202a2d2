"""Benchmark decontamination by winnowed word fingerprints.

A *window* is ``window`` consecutive words of a benchmark item; an item of fewer words (but not none) is one
window. Every document word inside any occurrence of a window is *hit*.

*Winnowing* (Schleimer, Wilkerson, Aiken 2003). The hashes of all k-grams of words are taken in order, and in
every run of w consecutive hashes the smallest (the rightmost of equals) is selected. With k + w - 1 = window,
every occurrence of a window holds a whole run, so document and item select the same k-gram at the same place
in it: no shared window is missed. Items shorter than ``window`` get a k and w of their own length. Document
and item fingerprints are joined, the words beside each seed are compared, and a run of equal words that is
long enough is a hit.

*Scale.* Documents are read once. A bitmap of fixed size (``bitmap_bits``) of the item fingerprints is
broadcast; fingerprints that it rules out never leave the task, and a full bitmap only sends more rows to the
join, which decides alone. Only seeds with the words beside them are shuffled, never texts, and joins are left
to adaptive execution, which splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import MEMOS, id_type, map_texts, pick, staged, text_key, word_list

WINDOW, BITMAP_BITS, CACHE = 13, 1 << 24, 1 << 20
_MULT, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def gram_sizes(length: int) -> tuple[int, int]:
    """k and w for windows of ``length`` words, k + w - 1 = length."""
    k = (length + 1) // 2 + length // 13
    return k, length - k + 1


class _Hashes(dict):
    """Word to 64-bit hash; forgets all when full, which changes no result."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxh64_intdigest(word)
        return h


_hashes = _Hashes()
MEMOS[__name__] = _hashes.clear


def _word_hashes(words: list[bytes]):
    import numpy as np
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def _gram_hashes(h, k: int):
    """Hash of every k consecutive words, mixed so that the smallest is as good as random."""
    import numpy as np
    n = len(h) - k + 1
    g = h[:n].copy()
    for j in range(1, k):
        g *= np.uint64(_MULT)
        g += h[j:j + n]
    g ^= g >> np.uint64(32)
    g *= np.uint64(_MIX)
    g ^= g >> np.uint64(32)
    return g


def _selected(g, w: int):
    """Places of the smallest hash, the rightmost of equals, in each run of w."""
    import numpy as np
    runs = np.lib.stride_tricks.sliding_window_view(g, w)[:, ::-1]
    return np.unique(np.arange(len(runs)) + (w - 1) - runs.argmin(axis=1))


def _seeds(words: list[bytes], lengths: list[int], keep) -> list[tuple[int, int, int, int, bytes]]:
    """``(length, hash, place, words to the left, words joined)`` of the selected k-grams that ``keep`` passes."""
    import numpy as np
    out = []
    h = _word_hashes(words) if len(words) >= min(lengths, default=1) else None
    for length in lengths:
        if len(words) < length:
            continue
        k, w = gram_sizes(length)
        g = _gram_hashes(h, k)
        passed = keep(g)
        if not passed.any():
            continue
        at = _selected(g, w)
        at = at[passed[at]]
        for p, x in zip(at.tolist(), g[at].view(np.int64).tolist()):
            left = min(w - 1, p)
            out.append((length, x, p, left, b" ".join(words[p - left:p + k + w - 1])))
    return out


_SEED = "length int, hash bigint, place int, n_left int, words binary"


def _item_seeds(benchmark: DataFrame, window: int) -> DataFrame:
    """Seeds of every item, for the one length that it takes part with."""
    import numpy as np

    def step(batch: dict) -> dict:
        out = {c: [] for c in ("item", "length", "hash", "place", "n_left", "words")}
        for item, text in zip(batch["item"], batch["text"]):
            words = word_list(text)
            if words:
                for seed in _seeds(words, [min(window, len(words))], lambda g: np.ones(len(g), dtype=bool)):
                    for c, v in zip(out, (item, *seed)):
                        out[c].append(v)
        return out
    return map_texts(benchmark, step, f"item {id_type(benchmark, 'item')}, {_SEED}")


def _bitmap(seeds: DataFrame, bits: int):
    """The seeds' hashes as a bitmap of ``bits`` bits: at most bits / 64 rows come to the driver."""
    import numpy as np
    slot = F.col("hash").bitwiseAND(F.lit(bits - 1))
    rows = seeds.select(F.shiftrightunsigned(slot, 6).alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit")) \
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("m")).collect()
    out = np.zeros(bits // 64, dtype=np.int64)
    for r in rows:
        out[r["word"]] = r["m"]
    return out.view(np.uint8)


def _document_rows(docs: DataFrame, seeds: DataFrame, bits: int) -> DataFrame:
    """A row per document (length null) with its word count, and a row per seed that the bitmap passes."""
    spark = docs.sparkSession
    lengths = sorted(r[0] for r in seeds.select("length").distinct().collect())  # at most `window` of them
    bitmap = spark.sparkContext.broadcast(_bitmap(seeds, bits))

    def step(batch: dict) -> dict:
        import numpy as np
        bytes_ = bitmap.value

        def keep(g):
            slot = g & np.uint64(bits - 1)
            return (bytes_[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

        out = {c: [] for c in ("id", "key", "n_words", "length", "hash", "place", "n_left", "words")}
        for id_, text in zip(batch["id"], batch["text"]):
            words = word_list(text)
            head = (id_, text_key(text), len(words))
            for seed in [(None,) * 5, *_seeds(words, lengths, keep)]:
                for c, v in zip(out, head + seed):
                    out[c].append(v)
        return out
    return map_texts(docs, step, f"id {id_type(docs)}, key bigint, n_words bigint, {_SEED}")


def _extend(pairs: DataFrame) -> DataFrame:
    """Compare the words beside each joined seed; keep runs of at least ``length`` equal words."""
    def step(batch: dict) -> dict:
        out = {c: [] for c in ("id", "key", "item", "start", "stop")}
        for id_, key, item, length, p, n1, t1, n2, t2 in zip(*(batch[c] for c in (
                "id", "key", "item", "length", "place", "n_left", "words", "item_left", "item_words"))):
            k = gram_sizes(length)[0]
            a, b = t1.split(b" "), t2.split(b" ")
            if a[n1:n1 + k] != b[n2:n2 + k]:
                continue
            left = right = 0
            while left < min(n1, n2) and a[n1 - left - 1] == b[n2 - left - 1]:
                left += 1
            while right < min(len(a) - n1, len(b) - n2) - k and a[n1 + k + right] == b[n2 + k + right]:
                right += 1
            if left + k + right >= length:
                for c, v in zip(out, (id_, key, item, p - left, p + k + right)):
                    out[c].append(v)
        return out
    return map_texts(pairs, step, f"id {id_type(pairs)}, key bigint, item {id_type(pairs, 'item')}, start bigint, stop bigint")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """``id, key, n_words, n_hit, n_items, items`` (sorted item ids as strings), one row per row of ``docs``.

    Null, empty and wordless texts have no words and no hits; rows equal in id and text are alike. Items
    without words never occur; items with a null id hit words but are not listed. Empty tables give empty
    results or no hits. Extra columns are ignored.
    """
    seeds = staged(_item_seeds(pick(benchmark, item=item_col, text=item_text_col), window), "winnow-items")
    rows = staged(_document_rows(pick(docs, id=id_col, text=text_col), seeds, bitmap_bits), "winnow-documents")
    found = rows.filter("length is not null").drop("n_words").distinct()
    pairs = found.join(seeds.select("item", "length", "hash", F.col("n_left").alias("item_left"),
                                    F.col("words").alias("item_words")).distinct(), ["length", "hash"])
    hits = _extend(pairs).groupBy("id", "key").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("runs"),
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    covered = F.expr("""aggregate(runs, named_struct('upto', 0L, 'n', 0L),
        (a, r) -> named_struct('upto', greatest(a.upto, r.stop),
                               'n', a.n + greatest(0L, r.stop - greatest(a.upto, r.start))), a -> a.n)""")
    hits = hits.select(F.col("id").alias("hit_id"), F.col("key").alias("hit_key"), covered.alias("n_hit"), "items")
    return rows.filter("length is null").select("id", "key", "n_words") \
        .join(hits, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left") \
        .select("id", "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def is_contaminated():
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
