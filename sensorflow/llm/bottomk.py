"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's shingles are its runs of ``shingle`` words (``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text of fewer
words is one shingle, a text without words has none). Each shingle is hashed to 48 bits, the first 12 hex digits of
its MD5, and the sketch keeps the ``k`` smallest distinct hashes in ascending order. A sketch that holds fewer than
``k`` hashes holds them all, and every estimate from such sketches is exact.

*Merging.* The ``k`` smallest hashes of a union are among the ``k`` smallest of its parts, so ``merged`` of the
sketches of two parts is the sketch of both, and ``merge_sketches`` does it for groups of rows: hashes are made
distinct per group by a partial aggregate, every task keeps its ``k`` smallest of a group (Spark's window group limit)
before rows are shuffled, so a group that holds a third of all rows costs ``k`` rows a task.

*Estimates.* With u the k smallest hashes of the union of two sketches, ``resemblance`` is the share of u that both
hold, ``distinct_shingles`` is (k - 1) divided by the k-th smallest hash as a fraction of the hash range, and
``containment`` of a in b is resemblance x distinct(a or b) / distinct(a), at most 1. Two texts without shingles
resemble each other by 1, one without and one with by 0.

*Odd input.* A null text is an empty text. Texts of any length are taken whole; work is linear in their length (and
n log n in sorting their hashes). Repeated rows stay, each with its own result. ``fingerprints`` orders documents by
id (null first) and, for equal ids, by the MD5 of the text; rows of equal id and text are one document in that order.
An empty table gives an empty result. Extra columns are ignored, whatever they are called.

Only DataFrame functions are used. Nothing is collected; the one broadcast is a row per range of ``numbered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm.common import ascii_lower, col, fresh, let, numbered, pick, staged

K, SHINGLE = 128, 5
#: Hex digits of a hash; 48 bits tell 2^40 shingles apart at the bottom of the range.
DIGITS = 12
WORD = r"[^\x20\x09-\x0D]+"


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """The hash of every shingle of the text, repeats included, in order."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - shingle, F.lit(0)))
        # words beyond the last are null, which concat_ws leaves out
        return F.when(F.size(w) > 0, F.transform(starts, lambda i: F.left(F.md5(F.concat_ws(
            " ", *[F.get(w, i + j) for j in range(shingle)]).cast("binary")), F.lit(DIGITS)))) \
            .otherwise(F.array().cast("array<string>"))
    return let(words, hashes)


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The bottom-k sketch of a text: an ascending array of at most ``k`` hashes."""
    return smallest(shingle_hashes(text, shingle), k)


def as_text(s: Column) -> Column:
    """A sketch as one string, 12 hex digits a hash; ``from_text`` reads it back."""
    return F.array_join(s, "")


def from_text(fingerprint: Column) -> Column:
    n = F.length(fingerprint) / DIGITS
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: F.substring(
        fingerprint, i * DIGITS + 1, F.lit(DIGITS)))).otherwise(F.array().cast("array<string>"))


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of what the texts of ``a`` and ``b`` hold together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the distinct shingles of both that both hold (0 to 1)."""
    both = let(merged(a, b, k), lambda u: F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both)


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles, exact below ``k``."""
    last = F.conv(F.element_at(s, -1), 16, 10).cast("double") / float(1 << 4 * DIGITS)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(F.try_divide(F.lit(float(k - 1)), last))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's distinct shingles that b holds (0 to 1); 1 if a has none."""
    share = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k) / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(share, F.lit(1.0)))


def merge_sketches(df: DataFrame, by: list[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of ``by``: that of all the group's texts together, from the sketches of its rows."""
    h, n, out = fresh(df.select(*map(col, by)), "hash", "n", "sketch")
    keys = [col(c) for c in by]
    each = df.select(*keys, F.explode_outer(col(sketch_col)).alias(h)).groupBy(*keys, h).agg(F.lit(1).alias(n))
    least = each.withColumn(n, F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(h).asc_nulls_last()))).filter(F.col(n) <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list(h)).alias(out))


def successors(docs: DataFrame) -> DataFrame:
    """``ident, key, n, next_ident, next_key`` of every distinct document: the one after it by id and key.

    ``docs`` has ``id, ident, key, n``. The last document's next is the first; one that is alone is its own next.
    """
    places = staged(numbered(docs.select("id", "ident", "key", "n").distinct(), "place", "id", "key"), "places")
    after = places.select(F.col("ident").alias("next_ident"), F.col("key").alias("next_key"), F.col("place").alias("next_place"))
    return places.withColumn("next_place", F.col("place") % F.lit(max(places.count(), 1)) + 1) \
        .join(after, "next_place").select("ident", "key", "n", "next_ident", "next_key")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """``id, text, edited, fingerprint, edited_fingerprint, near_edited, near_next`` of every row of ``docs``.

    ``edited`` is the text whose last floor(n / 2) code points are replaced by the first as many (or all) of the next
    document. A document sends its opening and its sketch to the one before it, keyed by that one's id and key, so no
    order is computed over texts; texts are shuffled once by their own key and their openings once more.
    """
    text = F.coalesce("text", F.lit(""))
    rows = pick(docs, id=id_col, text=text_col).select(
        # an id that is never null, so that plain equality joins and keeps the partitioning
        "id", F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("")).alias("ident"), F.md5(text.cast("binary")).alias("key"),
        text.alias("text"))
    after = successors(rows.withColumn("n", F.length("text")))
    keyed = rows.drop("id").withColumn("sketch", F.unhex(as_text(sketch(F.col("text"), k, shingle)))) \
        .repartition("ident", "key")  # the same exchange serves both uses below
    back = after.select(F.col("ident").alias("to_ident"), F.col("key").alias("to_key"), F.col("n").alias("to_n"),
                        F.col("next_ident").alias("ident"), F.col("next_key").alias("key"))
    openings = keyed.dropDuplicates(["ident", "key"]).join(back, ["ident", "key"]).select(
        F.col("to_ident").alias("ident"), F.col("to_key").alias("key"),
        F.left("text", (F.col("to_n") / 2).cast("int")).alias("opening"), F.col("sketch").alias("next_sketch"))
    half = (F.length("text") / 2).cast("int")
    met = keyed.join(openings, ["ident", "key"]) \
        .select(F.when(F.col("ident") != "", F.substring("ident", 2, 1 << 30).cast(rows.schema["id"].dataType)).alias("id"), "text",
                F.concat(F.left("text", F.length("text") - half), F.left("opening", half)).alias("edited"),
                F.lower(F.hex("sketch")).alias("fingerprint"), F.lower(F.hex("next_sketch")).alias("next_fingerprint"))
    met = met.withColumn("edited_fingerprint", as_text(sketch(F.col("edited"), k, shingle)))

    def near(other: str) -> Column:
        return let(F.struct(from_text(F.col("fingerprint")).alias("a"), from_text(F.col(other)).alias("b")),
                   lambda s: resemblance(s["a"], s["b"], k))
    return met.select("id", "text", "edited", "fingerprint", "edited_fingerprint", near("edited_fingerprint").alias("near_edited"),
                      near("next_fingerprint").alias("near_next"))
