"""Secret scans: three patterns, and character Markov models of random strings against ordinary identifiers.

*Patterns* give the base spans. *Models*: long runs of key characters are scored by the log-likelihood ratio of
two first-order Markov chains over characters, one trained on random strings (the values that the patterns find
in a bounded sample of documents, and generated hex, base-64 and upper-case strings), one on ordinary
identifiers (words of the same documents outside the patterns' finds). A run whose ratio a transition, and in
sum, is high enough is a span of kind ``markov``. In other runs every stretch is weighed: a running maximum sum
over the transitions cuts out the best ones, also behind path words or key names, and no stretch touches a base
span. A stretch of a run has at least ``min_stretch`` characters.

*Scale.* Training counts transitions with partial sums (at most 2 x 128^2 of them come to the driver) and gives
one table of 128 x 128 numbers, a constant of the scan. The scan is one pass without a shuffle, in built-in
functions only. The sample bound is ``sample_docs``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm.common import hash_sample, pick, staged

#: Kind and pattern (fixed values). Only the key words take either case.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")

#: Runs that are scored. A maximal run of 32+ hex digits is found as such: no shorter match can hide it.
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}"
HEX_LONG, ACCESS_LONG = r"[0-9a-f]{32,}", r"AKIA[A-Z0-9]{12,}"
SIZE = 128
#: The score of a transition that no stretch crosses.
CUT = "-1e9D"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: Elements of a block of sums, and of a block of transitions. Each step of an SQL ``aggregate`` copies its state, so
#: what is gathered from a long array is gathered block by block, and the blocks' results one by one.
BLOCK, LONG_BLOCK = 512, 16384


def _blocks(array: str, size: int) -> str:
    """SQL for the array cut into blocks of ``size``, bound once."""
    return (f"transform(array({array}), l -> transform(sequence(0, greatest(size(l) - 1, 0) div {size}), "
            f"k -> slice(l, k * {size} + 1, {size})))[0]")


def _before(array: str) -> str:
    """SQL for the sums of the elements before each, of an array as short as a block or a list of blocks."""
    return (f"aggregate({array}, named_struct('t', 0, 'out', cast(array() AS array<int>)), "
            "(a, x) -> named_struct('t', a.t + x, 'out', concat(a.out, array(a.t))), a -> a.out)")


def running(array: str) -> str:
    """SQL for the sums of the elements before each of an ``array<int>`` of any length: within blocks, then of blocks."""
    sums = _before("transform(bs, x -> aggregate(x, 0, (t, y) -> t + y))")
    return (f"transform(array({_blocks(array, BLOCK)}), bs -> flatten(zip_with(bs, {sums}, "
            f"(x, base) -> transform({_before('x')}, y -> y + base))))[0]")


def spans_of(text: str, pattern: str, keep: str = "true") -> str:
    """SQL for the ``array<struct<s,e,v>>`` of the pattern's leftmost non-overlapping matches in column ``text``.

    Places are code points, end exclusive; v is the match. Matches and the gaps before them (the text split
    at the pattern) stand side by side, so the running sum of their lengths is the place. ``keep`` filters ``x.v``.
    """
    p = _literal(pattern)
    sizes = "transform(vg, x -> length(x.g) + coalesce(length(x.v), 0))"
    return f"""CASE WHEN {text} RLIKE {p} THEN transform(array(
        zip_with(regexp_extract_all({text}, {p}, 0), split({text}, {p}, -1), (v, g) -> named_struct('v', v, 'g', g))),
        vg -> filter(zip_with(vg, {running(sizes)}, (x, at) -> named_struct(
            's', at + length(x.g), 'e', at + length(x.g) + length(x.v), 'v', x.v)), x -> x.v IS NOT NULL AND {keep}))[0]
        ELSE cast(array() AS array<struct<s:int,e:int,v:string>>) END"""


def base_spans(text: str = "text") -> dict[str, Column]:
    """The base spans of each kind; failing matches are dropped after matching."""
    return {"assign": F.expr(spans_of(text, ASSIGN, f"length(regexp_extract(x.v, {_literal('^(?s:' + ASSIGN + ')')}, 2)) >= 8")),
            "access": F.expr(spans_of(text, ACCESS, "length(x.v) >= 16")),
            "hex": F.expr(spans_of(text, HEX_LONG))}


def _transitions(samples: DataFrame) -> DataFrame:
    """``label, a, b, n``: counts of neighbouring characters (codes under 128) in ``samples`` (label, token)."""
    chars = F.expr("transform(filter(split(token, ''), c -> c <> ''), c -> ascii(c))")
    pairs = F.expr("zip_with(slice(c, 1, size(c) - 1), slice(c, 2, size(c) - 1), (a, b) -> a * 128 + b)")
    return samples.filter("length(token) >= 2").select("label", chars.alias("c")) \
        .select("label", F.explode_outer(pairs).alias("pair")).filter(f"pair >= 0 and pair < {SIZE * SIZE}") \
        .groupBy("label", "pair").agg(F.count("*").alias("n"))


def train(samples: DataFrame, prior: float = 0.5) -> list[float]:
    """Log-likelihood ratio of each transition, a flat 128 x 128 table, from ``samples`` (label, token).

    Label 1 is random, 0 ordinary. ``prior`` is added to each count of the 67 key characters.
    """
    counts = {0: {}, 1: {}}
    for r in _transitions(samples).collect():  # at most 2 x 128^2 rows
        counts[r["label"]][r["pair"]] = r["n"]
    key = [c for c in range(SIZE) if chr(c).isalnum() or chr(c) in "+/_=-"]
    table = [0.0] * (SIZE * SIZE)
    for a in key:
        row = {label: [counts[label].get(a * SIZE + b, 0) + prior for b in key] for label in (0, 1)}
        total = {label: sum(r) for label, r in row.items()}
        for b, x1, x0 in zip(key, row[1], row[0]):
            table[a * SIZE + b] = round(math.log(x1 / total[1]) - math.log(x0 / total[0]), 4)
    return table


def generated(spark: SparkSession, n: int) -> DataFrame:
    """``n`` random strings in each of three alphabets, made from hashes of 0 to n - 1."""
    raw = F.unhex(F.sha2(F.col("id").cast("string"), 256))
    kinds = F.array(F.lower(F.hex(raw)), F.regexp_replace(F.base64(raw), r"\s", ""),
                    F.translate(F.upper(F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat(F.col("id").cast("string"), F.lit("u")), 256))),
                                                         r"\s", "")), "+/=", "723"))
    return spark.range(n).select(F.lit(1).alias("label"), F.explode(kinds).alias("token"))


def labelled_samples(docs: DataFrame, sample_docs: int = 2000, n_generated: int = 2000) -> DataFrame:
    """``label, token``: values found by the patterns (1) and words outside their finds (0), and generated strings (1).

    Words are taken as they are and three by three as snake, kebab, path and camel identifiers.

    About ``sample_docs`` documents are taken, those of the smallest hashes, never over twice as many.
    """
    some = hash_sample(docs, sample_docs, "id", "text").select(F.coalesce("text", F.lit("")).alias("text"))
    some = staged(some.repartition(32), "secret-sample")  # the sample's limit left one partition
    found = some.select("text", F.flatten(F.array(*base_spans().values())).alias("hits"))
    secret = found.select(F.explode_outer("hits.v").alias("v")) \
        .select(F.lit(1).alias("label"), F.regexp_extract("v", r"([A-Za-z0-9+/_=-]+)$", 1).alias("token"))
    rest = F.col("text")
    for pattern in (ASSIGN, ACCESS_LONG, HEX_LONG):
        rest = F.regexp_replace(rest, pattern, " ")
    three = "transform(sequence(1, greatest(1, size(w) - 2), 3), i -> {})"
    parts = "get(w, i - 1), get(w, i), get(w, i + 1)"
    forms = [F.expr(three.format(f"concat_ws('{mark}', {parts})")) for mark in "_-/"] \
        + [F.expr(three.format(f"replace(initcap(concat_ws(' ', {parts})), ' ', '')"))]
    words = found.select(F.regexp_extract_all(rest, F.lit("[A-Za-z][A-Za-z0-9_-]{2,}"), F.lit(0)).alias("w")) \
        .select(F.explode(F.concat(F.col("w"), *forms)).alias("token")).select(F.lit(0).alias("label"), "token")
    return secret.unionByName(words).unionByName(generated(docs.sparkSession, n_generated))


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: DataFrame | None = None,
                 min_length: int = 20, min_mean: float = 0.5, min_sum: float = 12.0, sample_docs: int = 2000,
                 min_stretch: int = 16) -> DataFrame:
    """``id`` and ``spans``, an array of (s, k, e) with k the place of the kind in ``KINDS``, sorted; a row per row of ``df``.

    ``samples`` (label, token) train the models; by default they come from ``df`` itself. A null text counts as
XX keep a row each; an empty table gives an empty result; extra columns
    are ignored.
    """
    docs = pick(df, id=id_col, text=text_col)
    table = train(labelled_samples(docs, sample_docs) if samples is None else samples)
    ratio = "split('" + ",".join(f"{x:g}" for x in table) + "', ',')"  # folded to one constant array
    rows = docs.select("id", F.coalesce("text", F.lit("")).alias("text"))
    runs = F.expr(spans_of("text", CANDIDATE % min_length))
    rows = rows.select("id", *[c.alias(k) for k, c in base_spans().items()], runs.alias("runs"))
    base = F.expr("flatten(array(transform(assign, x -> named_struct('s', x.s, 'k', 0, 'e', x.e)), "
                  "transform(access, x -> named_struct('s', x.s, 'k', 1, 'e', x.e)), "
                  "transform(hex, x -> named_struct('s', x.s, 'k', 2, 'e', x.e))))")
    rows = rows.select("id", base.alias("base"), "runs")
    touched = "exists(r.base, b -> b.s < r.s + i + 2 AND b.e > r.s + i)"
    coded = F.expr("""transform(runs, r -> named_struct('s', r.s, 'e', r.e, 'c', transform(split(r.v, ''), c -> ascii(c)),
        'base', filter(base, b -> b.s < r.e AND b.e > r.s)))""")
    scored = rows.withColumn("coded", coded).withColumn("score", F.expr(f"""transform(coded, r -> transform(sequence(0, r.e - r.s - 2),
        i -> if({touched}, {CUT}, element_at(cast({ratio} AS array<double>), get(r.c, i) * 128 + get(r.c, i + 1) + 1))))"""))
    extra = F.expr(f"""flatten(transform(arrays_zip(coded, score), x -> transform(
        if(aggregate(x.score, 0.0D, (t, y) -> t + y) >= greatest({min_sum}D, {min_mean}D * size(x.score)),
           array(named_struct('f', 0, 'u', size(x.score))), {stretches('x.score', min_sum, min_mean, min_stretch)}),
        y -> named_struct('s', x.coded.s + y.f, 'k', 3, 'e', x.coded.s + y.u + 1))))""")
    return scored.select("id", F.array_sort(F.concat("base", extra)).alias("spans"))


def stretches(scores: str, min_sum: float, min_mean: float, min_stretch: int) -> str:
    """SQL for the ``array<struct<f,u>>`` of the best stretches (first transition, end exclusive) of an array of scores.

    A stretch grows while its sum is above 0 and less than ``min_sum`` below its maximum, and ends at the maximum.
    The state is carried from block to block; the finds of a block are put aside as one element.
    """
    good = f"a.m >= {min_sum}D AND a.m >= {min_mean}D * (a.u - a.f) AND a.u - a.f >= {min_stretch - 1}"
    ends = f"(a.t + y <= 0 OR a.t + y <= a.m - {min_sum}D)"
    none = "cast(array() AS array<struct<f:int,u:int>>)"
    step = (f"named_struct('i', a.i + 1, 't', if({ends}, 0.0D, a.t + y), 'f', if({ends}, a.i + 1, a.f), "
            f"'m', if({ends}, 0.0D, greatest(a.m, a.t + y)), 'u', if({ends} OR a.t + y > a.m, a.i + 1, a.u), "
            f"'out', if({ends} AND {good}, concat(a.out, array(named_struct('f', a.f, 'u', a.u))), a.out))")
    empty = f"named_struct('i', 0, 't', 0.0D, 'f', 0, 'm', 0.0D, 'u', 0, 'out', {none})"
    carried = f"named_struct('i', s.a.i, 't', s.a.t, 'f', s.a.f, 'm', s.a.m, 'u', s.a.u, 'out', {none})"
    return f"""aggregate({_blocks(f"concat({scores}, array({CUT}))", LONG_BLOCK)},
        named_struct('a', {empty}, 'every', cast(array() AS array<array<struct<f:int,u:int>>>)),
        (s, b) -> transform(array(aggregate(b, {carried}, (a, y) -> {step})),
            a -> named_struct('a', a, 'every', concat(s.every, array(a.out))))[0], s -> flatten(s.every))"""


def joined(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"], x["e"])), ",")
