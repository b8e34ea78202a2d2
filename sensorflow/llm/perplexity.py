"""Quality rules: plain counts, and perplexity bands under an n-gram model of the corpus itself.

*Model.* Order-5 modified Kneser-Ney over whole code points, one model per language (``ngrams``). Its tables grow
with the corpus, stay in the shared folder and are fetched batch by batch in a shuffle join.

*Foreign passages.* A document is scored in blocks of 128 characters under its own language's model. Blocks clearly
above that model's cross-entropy are also scored under the other languages' models, each relative to its own
cross-entropy, and take the best, so a clean passage in another language does not reject a document, while noise is noise in any language.

*Bands.* Documents' log perplexities are counted on a fixed grid per language; a document is rejected below
q1 - spread * (q3 - q1) or above q3 + spread * (q3 - q1), the quartiles taken over all documents of the language
that pass the plain rules.

*Weights.* Model and quartiles count each distinct text of a language once, its copies sharing the weight, and a
source at most as much as the language's median source (the lower one), so none of k sources weighs over 2 / k.
Noise of one hot source, or copied often, then neither teaches the model nor moves the band.
"""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm import ngrams
from sensorflow.llm.common import WRITTEN, col, forget, give_back, id_type, importable, pick, release, shuffles_removed, staged, staged_in_turn, text_key
from sensorflow.operators.joins import dim_join
from sensorflow.session import scratch_dir

SPREAD, GRID, BLOCK, MARGIN = 3.5, 1000, 128, 0.15
#: Ranges of batches that fetch their n-grams one after the other, so that what they fetch takes that share of the disk.
ROUNDS = 6
WHITE, SYMBOLS = b" \t\n\r\x0b\x0c", b"#*$%&|<>"


def language(c: Column) -> Column:
    """The primary language subtag, lower-cased: two to eight letters before any ``-`` or ``_``; else ``other``."""
    tag = F.regexp_extract(F.lower(F.trim(c)), "^([a-z]{2,8})(?:[-_].*)?$", 1)
    return F.when(tag != "", tag).otherwise("other")


def weighted(docs: DataFrame) -> DataFrame:
    """``docs`` (lang, text, source) and ``weight``, in units of ``ngrams.UNIT``, as the module says."""
    keyed = docs.withColumn("key", F.xxhash64("text")).withColumn("src", F.xxhash64("source")).drop("source")
    texts = staged(keyed.filter("text <> ''").groupBy("lang", "key").agg(F.count("*").alias("copies"), F.min("src").alias("src")), "perplexity-texts")
    sizes = texts.groupBy("lang", "src").agg(F.count("*").alias("size"))
    cap = sizes.groupBy("lang").agg(F.expr("percentile_disc(0.5) within group (order by size)").alias("cap"))
    share = staged(sizes.join(cap, "lang").filter("size > cap").select("lang", "src", (F.col("cap") / F.col("size")).alias("share")),
                   "perplexity-sources")
    scale = lambda c: F.greatest(F.lit(1), F.round(ngrams.UNIT * c)).cast("bigint")
    copied = staged(texts.filter("copies > 1").join(share, ["lang", "src"], "left")
                    .select("lang", "key", scale(F.coalesce("share", F.lit(1.0)) / F.col("copies")).alias("copied")), "perplexity-copies")
    # both are tables of copied texts and large sources only: broadcast up to a checked size, so that texts stay where they are
    return dim_join(dim_join(keyed, copied, ["lang", "key"], "left"), share, ["lang", "src"], "left") \
        .withColumn("weight", F.coalesce("copied", scale(F.coalesce("share", F.lit(1.0))))).drop("key", "src", "copied", "share")


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words standing in windows of ``size`` words that are found twice or more, the first included."""
    grams = list(zip(*(words[i:] for i in range(size))))
    if len(set(grams)) == len(grams):
        return 0
    often = {g for g, n in Counter(grams).items() if n > 1}
    total, upto = 0, 0
    for i, g in enumerate(grams):
        if g in often:
            total += i + size - max(i, upto)
            upto = i + size
    return total


def plain_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text; a null counts as empty."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (len(words), len(text) - (len(data) - len(data.translate(None, WHITE))),
            len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words))


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def bucketed(df: DataFrame, by: str, buckets: int) -> DataFrame:
    """Write ``df`` to the shared folder in buckets of ``by``: a later grouping by it moves only what is joined to it.

    Spark knows buckets by a table; ``drop_tables`` takes it from the catalogue when its rows are used.
    """
    path, name = scratch_dir(df.sparkSession, "perplexity-batches"), f"perplexity_{uuid.uuid4().hex}"
    WRITTEN.append(path)
    df.write.bucketBy(buckets, by).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    _TABLES.append(name)
    return df.sparkSession.table(name)


_TABLES: list[str] = []


def drop_tables(spark) -> None:
    """Take the bucketed tables written so far from the catalogue."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")


def rounds(rows: DataFrame) -> list[Column]:
    """Conditions on ``bid`` that deal ``rows`` into at most ``ROUNDS`` ranges of about as many rows; the bounds come to the driver."""
    shares = ", ".join(str(i / ROUNDS) for i in range(1, ROUNDS))
    bounds = sorted(set(rows.agg(F.expr(f"percentile_approx(bid, array({shares}))")).first()[0] or ()))
    # a batch that is a bound ends its range
    return [(F.col("bid") > a if a is not None else F.lit(True)) & (F.col("bid") <= b if b is not None else F.lit(True))
            for a, b in zip([None, *bounds], [*bounds, None])]


def _scored(docs: DataFrame) -> list[DataFrame]:
    """``id, key, lang``, the plain counts and ``log_ppl`` (mean negative log probability a character; null if empty).

    One table for each of ``rounds``, to be written one after the other.
    """
    importable(docs.sparkSession)
    import pyarrow as pa

    def step(batch: dict) -> dict:
        out = {n: batch[n] for n in ("id", "lang", "text", "weight")} | {"key": [text_key(t) for t in batch["text"]]}
        return out | (dict(zip(_COUNTS, map(list, zip(*(plain_counts(t) for t in batch["text"]))))) if batch["id"] else {c: [] for c in _COUNTS})
    kept = f"id {id_type(docs)}, key bigint, lang string, weight bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = bucketed(ngrams.batched(docs, step, kept + ", text string"), "bid", 2 * -(-chars // ngrams.BATCH) + 1)
    grams = staged_in_turn([ngrams.seen(rows)], "perplexity-grams")
    mark = len(WRITTEN)
    model, entropy = ngrams.estimate(grams)
    model = staged_in_turn([model], "perplexity-model")
    release(docs.sparkSession, mark, keep=1)
    wanted = grams.filter("fetch").select("bid", "gram")

    def scores(lang: str, texts: list[str], found: ngrams.Fetched):
        import numpy as np
        c, starts, sizes = ngrams.points(texts)
        pads = (starts[:, None] + np.arange(ngrams.ORDER - 1)).ravel()
        first_at, at_gram = ngrams.distinct(ngrams.gram_hashes(c))
        grams = ngrams.gram_rows(c, first_at)
        p = found.log_p(lang, grams)[at_gram]
        p[pads] = 0
        per = -(-sizes // BLOCK)  # blocks of each text, its padding in the first
        first = np.cumsum(per) - per
        begin = np.repeat(starts - first * BLOCK, per) + np.arange(per.sum()) * BLOCK
        size = np.minimum(BLOCK, np.repeat(starts + sizes, per) - begin)
        total = -np.add.reduceat(p, begin, dtype=np.float64)
        odd = np.flatnonzero(total > (entropy[lang] + MARGIN) * size)
        if len(odd) and len(entropy) > 1:
            cut = np.cumsum(size[odd]) - size[odd]
            at = np.repeat(begin[odd] - cut, size[odd]) + np.arange(size[odd].sum())
            used, part = np.unique(at_gram[at], return_inverse=True)
            pad = np.isin(at, pads)
            for other in sorted(entropy):
                if other != lang:
                    q = found.log_p(other, grams[used])[part]
                    q[pad] = 0
                    level = entropy[lang] - entropy[other]  # languages differ in entropy
                    total[odd] = np.minimum(total[odd], level * size[odd] - np.add.reduceat(q, cut, dtype=np.float64))
        return np.add.reduceat(total, first) / (sizes - (ngrams.ORDER - 1))

    names = ["id", "key", "lang", "weight", *_COUNTS]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        import numpy as np
        forget()
        out = np.full(left.num_rows, np.nan)
        if right.num_rows:
            found = ngrams.Fetched(*(right.column(n).combine_chunks() for n in ("gram", "langs", "p", "b")))
        for begin in range(0, left.num_rows, 512):
            part = left.slice(begin, 512)
            texts, by = part.column("text").to_pylist(), {}
            for i, (lang, t) in enumerate(zip(part.column("lang").to_pylist(), texts)):
                if t:
                    by.setdefault(lang, []).append(i)
            for lang, some in by.items():
                for i, j in ngrams.pieces([len(texts[k]) for k in some]):
                    out[np.array(some[i:j]) + begin] = scores(lang, [texts[k] for k in some[i:j]], found)
        found = None
        give_back()
        return left.select(names).append_column("log_ppl", pa.array(out, pa.float64(), from_pandas=True))
    return [rows.filter(part).groupBy("bid").cogroup(wanted.filter(part).join(model, "gram").groupBy("bid"))
            .applyInArrow(score, kept + ", log_ppl double") for part in rounds(rows)]


def bands(scored: DataFrame, spread: float = SPREAD) -> DataFrame:
    """``lang, low, high`` from the quartiles of log_ppl by weight, counted on a grid of 1 / GRID."""
    cell = scored.filter("not base_failed and log_ppl is not null") \
        .groupBy("lang", F.floor(F.col("log_ppl") * GRID).alias("cell")).agg(F.sum("weight").alias("count"))
    upto = F.sum("count").over(Window.partitionBy("lang").orderBy("cell"))
    total = F.sum("count").over(Window.partitionBy("lang"))
    q = cell.select("lang", "cell", upto.alias("upto"), total.alias("total")).groupBy("lang").agg(
        *[F.min(F.when(F.col("upto") >= share * F.col("total"), F.col("cell"))).alias(n) for n, share in (("q1", 0.25), ("q3", 0.75))])
    reach = spread * (F.col("q3") - F.col("q1") + 1)
    return q.select("lang", ((F.col("q1") - reach) / GRID).alias("low"), ((F.col("q3") + 1 + reach) / GRID).alias("high"))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  min_words: int = 50, max_repeat_percent: int = 50, spread: float = SPREAD, source_col: str = "source") -> DataFrame:
    """``id, key, lang``, the plain counts, ``base_failed, log_ppl, low, high, kept``, one row per row of ``df``.

    A null text counts as empty, and an empty text fails the plain rules for its words. A null or odd language
    is ``other``. Without ``source_col`` all rows are of one source. A language none of whose documents passes the plain rules has no band and rejects no more.
    Repeated rows keep a row each; an empty table gives an empty result; extra columns are ignored.
    """
    source = {"source": source_col} if source_col in df.columns else {}
    docs = pick(df, id=id_col, text=text_col, lang=lang_col, **source).withColumn("lang", language(col("lang")))
    mark = len(WRITTEN)
    with shuffles_removed(df.sparkSession):
        docs = weighted(docs if source else docs.withColumn("source", F.lit(None).cast("string")))
        failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
        rows = staged_in_turn([part.withColumn("base_failed", failed) for part in _scored(docs)], "perplexity")
    drop_tables(df.sparkSession)
    release(df.sparkSession, mark, keep=1)  # the rows just written rest on none of the tables before
    inside = F.col("low").isNull() | F.col("log_ppl").isNull() | F.col("log_ppl").between(F.col("low"), F.col("high"))
    # three numbers a language
    return rows.join(F.broadcast(bands(rows, spread)), "lang", "left").withColumn("kept", ~F.col("base_failed") & inside).drop("weight")
