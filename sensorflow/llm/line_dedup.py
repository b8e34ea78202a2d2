"""Line dedup over content-defined chunks.

*Chunks.* Lines (split at ``\\n``) are hashed; empty ones don't count. A rolling hash over the last ``window`` line
hashes begins a chunk where it is 0 modulo ``divisor``. With a window of one line a boundary depends on its own line
alone, so lines put in or taken out elsewhere shift no other boundary, and a passage has the same boundaries wherever
it stands. A chunk is known by its head, its first two lines; a line of over ``min_words`` words is a head by itself.

*Removal.* Head hashes only name candidates: heads are compared byte by byte, as text keys of the grouping. From a
head that stands more than once the match is extended line by line, back to the head before and on to the next head,
as far as the lines equal those beside its first place (by id, then content key, then place; null ids last). The
passage is kept there and removed elsewhere, with the empty lines inside it. So a repeated passage goes as a whole if
it holds a head: a passage of n lines, none of them over ``min_words`` words, holds none in (1 - 1 / divisor)^(n - 1)
of cases. Lines beside a head are told apart by their 64-bit hash. A repeated line of few words alone stays.

*Scale.* Heads are found inside each row, without a shuffle. Only (document key, place, head hash) rows are shuffled
to count hashes; heads travel as text only for hashes seen twice, with the digests of the lines up to the heads beside
them. First places are partial minima, so a head that stands in a third of all documents is one row per task before it
is shuffled, and joins with hot heads are left to adaptive execution. Texts are shuffled to meet the places to be
fetched and removed. Long texts are read whole; work is linear in their lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import col, fresh, pick

WINDOW, DIVISOR, MIN_WORDS = 1, 2, 50


def _part(first: str, last: str, array: str = "full") -> str:
    """SQL for the elements ``first`` .. ``last`` of an array; none if last is less."""
    return f"if({last} < {first}, cast(array() AS array<string>), transform(sequence({first}, {last}), q -> get({array}, q)))"


def with_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (with text), its ``lines``, and ``at``: the places of those that aren't empty."""
    return docs.withColumn("lines", F.expr("split(text, '\\n', -1)")) \
        .withColumn("at", F.expr("filter(sequence(0, size(lines) - 1), i -> get(lines, i) <> '')"))


def with_chunks(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (with text), its lines that aren't empty (``full``) and its ``chunks``: (j, n, hash) in order.

    ``j`` is the first line of the head among the full lines, ``n`` the head's lines, ``hash`` that of its line hashes.
    """
    rolled = ", ".join(f"get(lh, j - {k})" for k in range(window))
    words = r"size(filter(split(x, '[\\x20\\x09-\\x0D]+'), w -> w <> ''))"
    blanks = r"length(x) - length(translate(x, ' \t\r\u000b\u000c', ''))"  # cheaper, and at least as many but one
    heads = (f"filter(sequence(0, size(lh) - 1), j -> get(long, j) OR "
             f"(j + 1 < size(lh) AND pmod(xxhash64({rolled}), {divisor}) = 0))")
    return with_lines(docs).withColumn("full", F.expr("transform(at, i -> get(lines, i))")).drop("lines", "at") \
        .withColumn("lh", F.expr("transform(full, x -> xxhash64(x))")) \
        .withColumn("long", F.expr(f"transform(full, x -> length(x) > {2 * min_words} AND {blanks} >= {min_words} AND {words} > {min_words})")) \
        .withColumn("chunks", F.expr(f"""if(size(lh) = 0, cast(array() AS array<struct<j:int,n:int,hash:bigint>>), transform({heads},
            j -> named_struct('j', j, 'n', if(get(long, j), 1, 2),
                              'hash', if(get(long, j), xxhash64(get(lh, j)), xxhash64(get(lh, j), get(lh, j + 1))))))""")).drop("lh", "long")


def passages_to_remove(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_words: int = MIN_WORDS) -> DataFrame:
    """``id, key, removed``: ranges (a, b) of full lines of each (id, key) of ``docs`` (id, key, text) that stand elsewhere first."""
    # explode_outer: a plain explode would have its array computed again in a pushed-down filter
    here = F.struct(F.col("id").isNull().alias("last"), "id", "key", "place")
    chunks = with_chunks(docs, window, divisor, min_words).select("id", "key", F.posexplode_outer("chunks").alias("place", "c")) \
        .filter("c IS NOT NULL").select("id", "key", "place", "c.hash")
    often = chunks.groupBy("hash").agg(F.min(here).alias("lo"), F.max(here).alias("hi")).filter("lo <> hi").select("hash")
    named = chunks.join(often, "hash", "left_semi").groupBy("id", "key") \
        .agg(F.collect_set("place").alias("places")).withColumnsRenamed({"id": "id2", "key": "key2"})
    fetched = docs.join(named, F.col("id").eqNullSafe(F.col("id2")) & (F.col("key") == F.col("key2"))) \
        .select("id", "key", "text", "places")
    c, digests = "get(chunks, p)", "transform({}, x -> xxhash64(x))"
    before, after = "coalesce(get(chunks, p - 1).j, 0)", "coalesce(get(chunks, p + 1).j, size(full) - 1)"
    fetched = with_chunks(fetched, window, divisor, min_words).select("id", "key", F.explode_outer(F.expr(f"""transform(places, p -> named_struct(
            'place', p, 'j', {c}.j, 'n', {c}.n, 'bytes', array_join({_part(f"{c}.j", f"{c}.j + {c}.n - 1")}, '\\n'),
            'left', {digests.format(_part(before, f"{c}.j - 1"))},
            'right', {digests.format(_part(f"{c}.j + {c}.n", after))}))""")).alias("c")).select("id", "key", "c.*")
    first = fetched.groupBy("bytes").agg(F.min(here).alias("lo"), F.max(here).alias("hi"), F.min_by(F.struct("j", "left", "right"), here).alias("f")) \
        .filter("lo <> hi").drop("hi")

    def alike(x: str, y: str) -> str:
        """How many elements two arrays begin with alike."""
        same = f"zip_with({x}, {y}, (u, v) -> coalesce(u = v, false))"
        return f"transform(array({same}), e -> if(array_position(e, false) = 0, size(e), cast(array_position(e, false) AS int) - 1))[0]"
    found = fetched.join(first, "bytes").filter(here != F.col("lo")).selectExpr(
        "id", "key", f"j - {alike('reverse(left)', 'reverse(f.left)')} AS a", f"j + n - 1 + {alike('right', 'f.right')} AS b",
        "if(lo.id <=> id AND lo.key = key, f.j + n, 0) AS least")  # a passage that runs into its own first place keeps that
    return found.selectExpr("id", "key", "greatest(a, least) AS a", "b").filter("a <= b") \
        .groupBy("id", "key").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("removed"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, divisor: int = DIVISOR,
                min_words: int = MIN_WORDS, removed_col: str | None = None) -> DataFrame:
    """``df`` with the repeated passages taken out of ``text_col``; other columns and all rows stay.

    ``removed_col`` names a column for the number of lines taken out (none by default), empty ones inside a passage
    included. A null text stays null, an empty one empty; a text all of whose lines go becomes empty. Rows equal in id
    and text are one place: they keep or lose the same lines. An empty table gives an empty result. Columns of any
    other name can't clash.
    """
    docs = pick(df, id=id_col, text=text_col).withColumn("key", F.xxhash64("text")).filter("text is not null")
    out = passages_to_remove(docs, window, divisor, min_words)
    id2, key, key2, removed = fresh(df, "id2", "key", "key2", "removed")
    out = out.select(F.col("id").alias(id2), F.col("key").alias(key2), F.col("removed").alias(removed))
    rows = df.withColumn(key, F.xxhash64(col(text_col))) \
        .join(out, col(id_col).eqNullSafe(col(id2)) & (col(key) == col(key2)), "left")
    # the row's own columns go aside in a struct, so that they can't clash with the names used here
    whole = "row"
    aside = rows.select(F.when(col(removed).isNotNull(), col(text_col)).alias("text"), col(removed).alias("removed"),
                        F.struct(*[col(c) for c in df.columns]).alias(whole))
    built = with_lines(aside).withColumn("gone", F.expr(
        "array_distinct(flatten(transform(removed, r -> sequence(get(at, r.a), get(at, r.b)))))"))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(lines) - 1), gone), i -> get(lines, i)), '\\n')")
    text = F.when(F.col("removed").isNull(), F.col(whole)[text_col]).otherwise(kept)
    columns = [text.alias(c) if c == text_col else F.col(whole)[c].alias(c) for c in df.columns]
    if removed_col:
        columns.append(F.coalesce(F.size("gone"), F.lit(0)).alias(removed_col))
    return built.select(*columns)
