"""Importance resampling of documents towards a target distribution.

Features are the runs of 1 to ``max_words`` consecutive words of a text, joined by one space, each hashed to one of
``buckets`` by its CRC-32. A bucket's gain is 1000 times the logarithm of its smoothed share in the target texts over
its smoothed share in all documents, rounded down; a document's weight is the floored mean gain of its features and its
score the weight plus Gumbel noise drawn from the seed and its id, so the highest scores are a weighted sample without
replacement.

*Array-scored weights.* Both corpora are counted by Spark: every task counts its texts into an array of buckets and
sends only that, then the arrays are added bucket by bucket. The gains, ``buckets`` numbers and no more, go to the tasks
as one array in which features are looked up.

*Numeric threshold bisection.* Scores are written to the shared folder; the cutoff is found by exact count jobs over
that table, each halving the range of scores four times (15 cut points a job). If more rows share the cutoff than may
still be drawn, the same search goes on among them by id, then by a hash of the text, then by the row's place in the
written table, so exactly the right number is drawn and no rows are sorted for it. Only the drawn rows are then dealt
by ranges of that order to be ranked.

*Odd input.* Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A null or empty text has no
features, weight 0 and is drawn only if ``min_words`` is 0. A null id draws its noise as the empty string and comes
last among equal scores; rows that repeat an id share its noise and are each drawn for themselves. Ids are integers.
Texts of any length are read whole, linear in their length, a text at a time. Without target texts every bucket's
target count is 0. An empty table gives an empty result. Extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.llm.common import importable, map_texts, numbered, pick, slices, staged, word_list

BUCKETS, SEED, MIN_WORDS = 10000, 2024, 20
#: Cut points of one count job: 2 ** HALVINGS - 1.
HALVINGS = 4


def feature_buckets(words: list[bytes], buckets: int = BUCKETS, max_words: int = 1) -> list[int]:
    from zlib import crc32
    out = [crc32(w) % buckets for w in words]
    for n in range(2, max_words + 1):
        out += [crc32(b" ".join(words[i:i + n])) % buckets for i in range(len(words) - n + 1)]
    return out


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, max_words: int = 1, text_col: str = "text") -> DataFrame:
    """``bucket, n``: how often features of all texts fall into each bucket (buckets without any are left out)."""
    importable(docs.sparkSession)

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        n = np.zeros(buckets, dtype=np.int64)
        for batch in slices(batches):
            for text in batch.column(0):  # a text at a time
                n += np.bincount(np.array(feature_buckets(word_list(text.as_py()), buckets, max_words), dtype=np.int64),
                                 minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["bucket", "n"])
    return pick(docs, text=text_col).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket, from ``bucket, n`` counts of both corpora: ``buckets`` numbers on the driver."""
    s, t = ({r["bucket"]: r["n"] for r in counts.collect()} for counts in (source, target))
    of_s, of_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    return [math.floor(1000 * math.log(((t.get(b, 0) + 1) * of_s) / ((s.get(b, 0) + 1) * of_t))) for b in range(buckets)]


def document_weights(docs: DataFrame, gains: list[int], max_words: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, key, n_words, n_features, weight`` of every row; ``key`` is a hash of the text."""
    import numpy as np
    table, buckets = np.array(gains, dtype=np.int64), len(gains)

    def step(cols: dict) -> dict:
        n_words, n_features, weight = [], [], []
        for text in cols["text"]:
            words = word_list(text)
            at = np.array(feature_buckets(words, buckets, max_words), dtype=np.int64)
            n_words.append(len(words))
            n_features.append(len(at))
            weight.append(int(table[at].sum()) // len(at) if len(at) else 0)
        return {"id": cols["id"], "key": cols["key"], "n_words": n_words, "n_features": n_features, "weight": weight}
    rows = pick(docs, id=id_col, text=text_col).withColumn("key", F.xxhash64("text"))
    if not isinstance(rows.schema["id"].dataType, T.IntegralType):
        raise ValueError("ids must be integers: equal scores are told apart by them")
    return map_texts(rows, step, f"id {rows.schema['id'].dataType.simpleString()}, key long, n_words long, n_features long, weight long")


def noise(ident: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)), u drawn from (0, 1) by the first 8 hex digits of sha256(``seed:id``)."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.left(drawn, F.lit(8)), 16, 10).cast("double") + 0.5) / float(1 << 32)
    return F.floor(F.ln(-F.ln(u)) * -1000.0)


def first_rows(rows: DataFrame, n: int, order: list[str]) -> Column:
    """A condition that holds for exactly the ``n`` first of ``rows`` by the integer columns ``order``, ascending.

    ``rows`` is a written table of at least ``n`` rows that ``order`` tells apart. Every job is one count.
    """
    if n <= 0:
        return F.lit(False)
    taken, tied = F.lit(False), F.lit(True)
    for name in order:
        c = F.col(name)
        among = rows.filter(tied)
        lo, hi = among.agg(F.min(c), F.max(c)).first()
        while lo < hi:  # the smallest value up to which at least n rows lie is in lo..hi
            cuts = sorted({lo + (hi - lo) * i // (1 << HALVINGS) for i in range(1, 1 << HALVINGS)})
            counts = among.agg(*[F.count_if(c <= F.lit(x)) for x in cuts]).first()
            enough = [x for x, m in zip(cuts, counts) if m >= n]
            short = [x for x, m in zip(cuts, counts) if m < n]
            lo, hi = max([lo, *[x + 1 for x in short]]), min([hi, *enough])
        below, at = among.agg(F.count_if(c < F.lit(lo)), F.count_if(c == F.lit(lo))).first()
        taken, tied, n = taken | (tied & (c < F.lit(lo))), tied & (c == F.lit(lo)), n - below
        if at == n:
            return taken | tied
    raise ValueError("order does not tell the rows apart")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, seed: int = SEED, buckets: int = BUCKETS, max_words: int = 1,
             min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """``id, n_features, weight, score, rank`` of every row of ``docs``.

    Of the N rows with at least ``min_words`` words the floor(percent x N / 100) highest scores are drawn and ranked
    from 1; equal scores go by smaller id. ``rank`` is null for the others.
    """
    gains = bucket_gains(bucket_counts(docs, buckets, max_words, text_col), bucket_counts(target, buckets, max_words, target_text_col), buckets)
    scored = document_weights(docs, gains, max_words, id_col, text_col)
    table = staged(scored.withColumn("score", F.col("weight") + noise(F.col("id"), seed)).withColumns({
        "from_top": -F.col("score"), "no_id": F.col("id").isNull().cast("int"), "some_id": F.coalesce("id", F.lit(0)),
        "place": F.monotonically_increasing_id()}), "scores")
    order = ["from_top", "no_id", "some_id", "key", "place"]
    able = F.col("n_words") >= min_words
    n = table.filter(able).count() * percent // 100
    drawn = able & first_rows(table.filter(able), n, order)
    kept = ["id", "n_features", "weight", "score"]
    ranked = numbered(table.filter(drawn), "rank", *order).select(*kept, F.col("rank").cast("long").alias("rank"))
    return table.filter(~drawn).select(*kept, F.lit(None).cast("long").alias("rank")).unionByName(ranked)
