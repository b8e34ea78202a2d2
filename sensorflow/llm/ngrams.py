"""Code-point n-gram language models whose tables grow with the corpus and are never broadcast.

*Model.* Order-5 modified Kneser-Ney (Chen and Goodman 1999) over whole code points, one model per language.
Grams travel as strings, so prefixes, suffixes and joins are exact. An n-gram of two code points or
more that only one text has is left to back-off (its mass too), so no text is predicted by its own sole traces.

*Scale.* Documents are dealt to batches of ``BATCH`` characters. A batch's distinct n-grams are counted where its
rows are (``seen``); the model is a grouped sum of them and one join per order. A batch fetches just its own
n-grams' entries by a shuffle join, and searches them as sorted hash arrays of one batch. Only the cross-entropy
of each language comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import forget, give_back, importable, slices, staged, staged_in_turn, text_key

ORDER, BATCH, POINTS = 5, 32 << 20, 0x110000
#: What a text that counts whole weighs.
UNIT = 1 << 20
PAD = " " * (ORDER - 1)
#: Rows of n-grams that a task gathers before it folds them.
FOLD = 1 << 18
#: Characters of the texts that a task takes at a time (one text at least), and rows of n-grams that it gives at a time.
PIECE, GIVEN = 1 << 19, 1 << 16
#: Shares of the n-grams that are counted one after the other, so that their shuffle takes that share of the disk.
TURNS = 3
SEEN = "bid bigint, lang string, gram string, n bigint, one bigint, fetch boolean"


def pieces(sizes) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of texts of about ``PIECE`` characters, one text at least."""
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and held + n > PIECE:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)


def points(texts: list[str]):
    """Code points of the padded texts, where each text starts, and the padded lengths."""
    import numpy as np
    c = np.frombuffer("".join(x for t in texts for x in (PAD, t)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter((len(t) + ORDER - 1 for t in texts), dtype=np.int64, count=len(texts))
    return c, np.cumsum(sizes) - sizes, sizes


def hashed(columns: list, n: int):
    """64-bit hashes of ``n`` n-grams given as columns of code points, first to last."""
    import numpy as np
    h = np.full(n, len(columns) + 1, dtype=np.uint64)
    for x in columns:
        h = (h ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _shifted(c, j: int):
    import numpy as np
    out = np.full(len(c), 0x20, dtype=c.dtype)
    out[j:] = c[:len(c) - j]
    return out


def gram_hashes(c):
    """Hash of the ``ORDER``-gram ending at each place."""
    return hashed([_shifted(c, j) for j in range(ORDER - 1, -1, -1)], len(c))


def gram_rows(c, at):
    """Code points of the ``ORDER``-grams that end at the places ``at``, a row each."""
    import numpy as np
    i = at[:, None] + np.arange(1 - ORDER, 1)
    return np.where(i >= 0, c[np.maximum(i, 0)], np.uint32(0x20))


def packed(rows):
    """A pyarrow string array of rows of code points."""
    import numpy as np
    import pyarrow as pa
    n, k = rows.shape
    size = (1 + (rows >= 0x80) + (rows >= 0x800) + (rows >= 0x10000)).sum(axis=1)
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    data = np.ascontiguousarray(rows, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def unpacked(grams):
    """Code points of a pyarrow string array without nulls, one text behind the other; no Python string a row."""
    import numpy as np
    import pyarrow as pa
    _, offsets, data = grams.buffers()
    ends = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(grams.type) else np.int32)[grams.offset:][:len(grams) + 1]
    text = str(memoryview(data)[ends[0]:ends[-1]], "utf-8", "surrogatepass") if len(grams) and ends[-1] > ends[0] else ""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def distinct(h):
    """A place of each distinct hash, ascending by hash, and for each place the number of its hash among them."""
    import numpy as np
    order = np.argsort(h)
    s = h[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))[:len(s)]
    number = np.empty(len(s), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def merged(h, n, lo, hi):
    """Distinct hashes, a place of each, and the sums of n, minima of lo and maxima of hi."""
    import numpy as np
    order = np.argsort(h)
    s = h[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    return (s[first], order[first], np.add.reduceat(n[order], first), np.minimum.reduceat(lo[order], first),
            np.maximum.reduceat(hi[order], first))


def batched(docs: DataFrame, step=None, schema: str | None = None) -> DataFrame:
    """``docs`` (with text) and ``bid``, its batch: rows that follow each other, about ``BATCH`` characters.

    ``step`` and ``schema``, as in ``map_texts``, change the rows before in the same pass: two passes one behind the
    other would keep two Python workers a task.
    """
    importable(docs.sparkSession)
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    names = schema or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    fields = to_arrow_schema(_parse_datatype_string(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext
        forget()
        first, chars = TaskContext.get().partitionId() << 32, 0
        for b in slices(batches):
            if step:
                made = step({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
                b = pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in fields], names=fields.names)
            bid = np.full(b.num_rows, first + chars // BATCH, dtype=np.int64)
            chars += b.column("text").nbytes
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bid)], names=[*b.schema.names, "bid"])
        give_back()
    return docs.mapInArrow(run, f"{names}, bid bigint")


def folded(parts: list[tuple]) -> tuple:
    """Parts (hashes, grams, n, lo, hi) as one, a row per distinct hash."""
    import numpy as np
    h, grams, n, lo, hi = map(np.concatenate, zip(*parts))
    h, at, n, lo, hi = merged(h, n, lo, hi)
    return h, grams[at], n, lo, hi


def seen(rows: DataFrame) -> DataFrame:
    """``bid, lang, gram, n, one, fetch`` of ``rows`` (bid, lang, text and perhaps weight): the ``ORDER``-grams of each batch.

    n sums the weights (``UNIT`` if there are none), one is the content key of their text, null if several texts have them. Shorter grams and
    grams that end in padding are there with n = 0, to be fetched only. fetch is true once for each gram of a batch,
    whatever languages have it. A batch's grams are sorted, which makes them small when written.
    """
    importable(rows.sparkSession)
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        forget()
        held: dict[str, list] = {}
        names = ["bid", "lang", "gram", "n", "one", "fetch"]

        def out(bid, lang, grams, n, lo, hi, fetch):
            first, rest = np.zeros((2, len(grams)), np.uint64)  # three code points each
            for j in range(6):
                half = first if j < 3 else rest
                half <<= np.uint64(21)
                if j < grams.shape[1]:
                    half |= grams[:, j]
            order = np.lexsort((rest, first))
            for at in (order[i:i + GIVEN] for i in range(0, len(order), GIVEN)):
                k, a, z = len(at), lo[at], hi[at]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, bid, np.int64)), pa.array([lang] * k, pa.string()), packed(grams[at]),
                                                  pa.array(n[at]), pa.array(a, mask=a != z), pa.array(fetch[at])], names=names)

        def flush(bid):
            found = {lang: folded(held.pop(lang)) for lang in list(held)}
            if found:
                at, _ = distinct(np.concatenate([x[0] for x in found.values()]))
                fetch = np.zeros(sum(len(x[0]) for x in found.values()), bool)
                fetch[at] = True
                grams = np.concatenate([x[1] for x in found.values()])[at]
                begin = 0
                while found:
                    lang = next(iter(found))
                    h, *row = found.pop(lang)
                    yield from out(bid, lang, *row, fetch[begin:begin + len(h)])
                    begin += len(h)
                for k in range(ORDER - 1, -1, -1):
                    grams = grams[:, 1:]
                    grams = grams[distinct(hashed(list(grams.T), len(grams)))[0]]
                    zero = np.zeros(len(grams), np.int64)
                    yield from out(bid, None, grams, zero, zero, zero, zero == 0)
            give_back()

        last = None
        for b in slices(batches):
            ids = b.column("bid").to_numpy()
            for bid in dict.fromkeys(ids.tolist()):
                if bid != last:
                    yield from flush(last)
                    last = bid
                by: dict[str, list[tuple]] = {}
                part = b.filter(pa.array(ids == bid))
                for lang, text, w in zip(*(part.column(n).to_pylist() for n in ("lang", "text", "weight"))):
                    if text:
                        by.setdefault(lang, []).append((text, w))
                for lang, texts, w in ((lang, *zip(*some[i:j])) for lang, some in by.items() for i, j in pieces([len(t) for t, _ in some])):
                    c, starts, sizes = points(texts)
                    weight, pads = np.repeat(np.array(w, np.int64), sizes), (starts[:, None] + np.arange(ORDER - 1)).ravel()
                    lo = np.repeat(np.array([text_key(t) for t in texts], np.int64), sizes)
                    hi = lo.copy()
                    weight[pads], lo[pads], hi[pads] = 0, np.iinfo(np.int64).max, np.iinfo(np.int64).min
                    h, at, n, lo, hi = merged(gram_hashes(c), weight, lo, hi)
                    parts = held.setdefault(lang, [])
                    parts.append((h, gram_rows(c, at), n, lo, hi))
                    # what is held stays within a few times the distinct n-grams, however often each was met
                    if sum(len(x[0]) for x in parts[1:]) > max(len(parts[0][0]), FOLD):
                        held[lang] = [folded(parts)]
        yield from flush(last)
    weight = F.col("weight") if "weight" in rows.columns else F.lit(UNIT).cast("bigint").alias("weight")
    return rows.select("bid", "lang", "text", weight).mapInArrow(run, SEEN)


def _part(first: int, n: int) -> Column:
    return F.substring("gram", first + 1, n)


def levels(grams: DataFrame) -> dict[int, DataFrame]:
    """``lang, gram, n, one`` of each order: counts of the highest, continuation counts below; ``one`` as in ``seen``."""
    one = F.when(F.count("one") == F.count("*"), F.when(F.min("one") == F.max("one"), F.min("one"))).alias("one")
    turn = F.pmod(F.xxhash64("gram"), F.lit(TURNS))
    out = {ORDER: staged_in_turn([grams.filter((F.col("n") > 0) & (turn == i)).groupBy("lang", "gram").agg(
        F.greatest(F.lit(1), F.round(F.sum("n") / UNIT)).cast("bigint").alias("n"), one) for i in range(TURNS)], "ngram-counts")}
    for k in range(ORDER - 1, 0, -1):
        out[k] = staged(out[k + 1].groupBy("lang", _part(1, k).alias("gram")).agg(F.count("*").alias("n"), one), "ngram-counts")
    return out


def discounts(level: DataFrame) -> DataFrame:
    """``lang, d1, d2, d3``: modified Kneser-Ney; 1/2 where the counts of counts leave one undefined."""
    c = level.groupBy("lang").agg(*[F.sum(F.when(F.col("n") == k, 1.0).otherwise(0.0)).alias(f"n{k}") for k in (1, 2, 3, 4)])
    return c.select("lang", *[F.expr(f"if(n{k} > 0 and n{k + 1} > 0, least(greatest("
                                     f"{k} - {k + 1} * n1 / (n1 + 2 * n2) * n{k + 1} / n{k}, 0.05D), {k} - 0.05D), 0.5D)").alias(f"d{k}")
                              for k in (1, 2, 3)])


def estimate(grams: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """The model, ``gram, langs, p, b`` (log probability and back-off weight in each language), and the languages' cross-entropies."""
    below, tables = None, []
    for k, level in sorted(levels(grams).items()):
        rows = level.join(F.broadcast(staged(discounts(level), "ngram-discounts")), "lang") \
            .select("lang", "gram", _part(0, k - 1).alias("prefix"), _part(1, k - 1).alias("suffix"), "n",
                    (F.lit(k == 1) | F.col("one").isNull()).alias("shared"),
                    F.expr("n - case n when 1 then d1 when 2 then d2 else d3 end").alias("left"))
        context = staged(rows.groupBy("lang", "prefix").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("shared"), F.col("left")).otherwise(0.0)).alias("used"))
                         .select("lang", "prefix", "total", (1 - F.col("used") / F.col("total")).alias("gamma")), "ngram-contexts")
        rows = rows.join(context, ["lang", "prefix"])
        if below is None:
            rows = rows.withColumn("low", F.lit(1.0 / POINTS))
        else:
            rows = rows.join(below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("low")), ["lang", "suffix"])
        p = F.when(F.col("shared"), F.col("left") / F.col("total")).otherwise(0.0) + F.col("gamma") * F.col("low")
        below = staged(rows.select("lang", "gram", "n", "shared", p.alias("p")), "ngram-probabilities")
        none = F.lit(None).cast("float")
        tables += [below.filter("shared").select("gram", "lang", F.log("p").cast("float").alias("p"), none.alias("b")),
                   context.filter("gamma < 1").select(F.col("prefix").alias("gram"), "lang", none.alias("p"), F.log("gamma").cast("float").alias("b"))]
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    # not staged: the join that fetches entries uses the grouping's exchange
    model = every.groupBy("gram").agg(F.collect_list(F.struct("lang", "p", "b")).alias("e")) \
        .select("gram", F.col("e.lang").alias("langs"), F.col("e.p").alias("p"), F.col("e.b").alias("b"))
    entropy = below.groupBy("lang").agg((-F.sum(F.col("n") * F.log("p")) / F.sum("n")).alias("e")).collect()  # a row per language
    return model, {r["lang"]: r["e"] for r in entropy}


class Fetched:
    """The entries that one batch fetched, as sorted hash arrays per language and order."""

    def __init__(self, grams, langs, p, b):
        import numpy as np
        import pyarrow.compute as pc
        size = pc.utf8_length(grams).to_numpy(zero_copy_only=False)
        c = unpacked(grams)
        ends = np.cumsum(size)
        h = np.zeros(len(size), np.uint64)
        for k in range(ORDER + 1):
            at = np.flatnonzero(size == k)
            h[at] = hashed([c[ends[at] - k + j] for j in range(k)], len(at))
        parent = pc.list_parent_indices(langs).to_numpy()
        lang = pc.list_flatten(langs).dictionary_encode()
        index = lang.indices.to_numpy()
        p, b = (pc.list_flatten(x).to_numpy(zero_copy_only=False).astype(np.float64) for x in (p, b))
        self.tables = {}
        for i, name in enumerate(lang.dictionary.to_pylist()):
            at = np.flatnonzero(index == i)
            at = at[np.argsort(h[parent[at]])]
            self.tables[name] = [(h[parent[some]], x[some]) for x in (p, b) for some in (at[~np.isnan(x[at])],)]

    def log_p(self, lang: str, grams):
        """Log probability of the last code point of each gram (a row of ``ORDER``), by bisection and back-off."""
        import numpy as np
        import math
        out, todo = np.zeros(len(grams)), np.arange(len(grams))
        if lang not in self.tables:
            return out - math.log(POINTS)

        def find(table, rows):
            hashes, values = table
            h = hashed(list(rows.T), len(rows))
            if not len(hashes):
                return np.zeros(len(h)), np.zeros(len(h), bool)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            return values[at], hashes[at] == h
        for k in range(ORDER, 0, -1):
            g = grams[todo, ORDER - k:]
            value, hit = find(self.tables[lang][0], g)
            out[todo[hit]] += value[hit]
            todo, g = todo[~hit], g[~hit]
            value, known = find(self.tables[lang][1], g[:, :-1])
            out[todo[known]] += value[known]
        out[todo] -= math.log(POINTS)
        return out
