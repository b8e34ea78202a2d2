"""Quality classifier: document evidence combined with host and path posteriors by hierarchical empirical Bayes.

*Evidence.* A document is the set of its words and of a few shape features (shares of capitals, symbols, bars and
repeated words, in steps). Sparse logistic regression (Spark ML) on a bounded sample of labelled documents gives
features weights; a document's sum less the prior log odds is its log-likelihood ratio. Two targets are judged:
low quality and toxicity.

*Hierarchy.* Evidence and the global rate give each document a probability. Its host's rate is the mean over the
host's documents, shrunk toward the global rate; its path's rate is shrunk toward the host's. The strengths of
shrinkage come from the spread between sites (method of moments), so sparse sites stay near their prior. The
document's posterior takes its path's rate as the prior odds, the document itself left out of both rates.

*Scale.* The corpus is read once for evidence; site sums are grouped aggregates with partial sums, so a host
with a third of all rows is a row per task. Only ``sample_rows`` documents are fitted, and ``max_features`` weights
and a handful of moments come to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import WORD_BYTES, col, hash_sample, id_type, map_texts, pick, salted_join, staged

TARGETS = ("bad", "toxic")
#: Tasks that fit the sample.
FIT_TASKS = 4
_UPPER = bytes(range(0x41, 0x5B))
_MARKS = b"#*$%&<>!@^~="


def _step(share: float) -> int:
    """0 to 8: the share in halves of halves, so that small shares are told apart."""
    return 0 if share <= 0 else max(1, 9 + math.ceil(math.log2(max(share, 1e-6))))


def features(text: str | None) -> set[bytes]:
    """The words of a text and its shape features (which begin with a byte that no word has); a null has few."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.translate(WORD_BYTES).split()
    out, n, size = set(words), max(1, len(words)), max(1, len(data))
    shares = (("up", (len(data) - len(data.translate(None, _UPPER))) / size),
              ("mark", (len(data) - len(data.translate(None, _MARKS))) / size),
              ("bar", data.count(b"|") / n), ("again", 1 - len(out) / n))
    return out | {b" %s%d" % (name.encode(), _step(share)) for name, share in shares} | {b" words%d" % min(12, len(words).bit_length())}


def labelled_sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """``text, bad, toxic`` of about ``sample_rows`` labelled ids, those of the smallest hashes, never over twice as many.

    Repeated labels of an id count once: toxic or bad if one says so. Null labels are 0 for toxic, 1 for quality.
    Of documents that share an id, one counts.
    """
    chosen = hash_sample(labels.filter("id is not null"), sample_rows, "id").groupBy("id") \
        .agg((1 - F.min(F.coalesce("quality", F.lit(1)))).alias("bad"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    found = docs.join(F.broadcast(chosen), "id")  # 2 x sample_rows small rows at most
    return found.groupBy("id").agg(F.max("text").alias("text"), F.first("bad").alias("bad"), F.first("toxic").alias("toxic")).drop("id")


def train(sample: DataFrame, max_features: int = 1 << 16, min_docs: int = 3, penalty: float = 3e-4) -> dict:
    """Per target of ``sample`` (text, bad, toxic): log odds ``prior``, ``weights`` by feature, and the curve's ``shift``.

    Features of fewer than ``min_docs`` sampled documents are left out. A sample of fewer than 20 rows, or one in
    which a class has fewer than 3, gives no weights and no evidence.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer

    def step(batch: dict) -> dict:
        return {"f": [[x.decode("utf-8", "replace") for x in features(t)] for t in batch["text"]]} | {t: batch[t] for t in TARGETS}

    rows = staged(map_texts(sample, step, "f array<string>, bad int, toxic int"), "bayes-sample")
    total = rows.agg(F.count("*").alias("n"), *[F.sum(t).alias(t) for t in TARGETS]).first()
    out = {t: {"prior": math.log((total[t] + 0.5) / (total["n"] - total[t] + 0.5)) if total["n"] else 0.0,
               "weights": {}, "shift": 0.0} for t in TARGETS}
    usable = [t for t in TARGETS if total["n"] >= 20 and min(total[t], total["n"] - total[t]) >= 3]
    if not usable:
        return out
    vocabulary = CountVectorizer(inputCol="f", outputCol="x", vocabSize=max_features, minDF=min_docs, binary=True).fit(rows)
    # the sample is bounded: in few partitions a step of the fit is one small stage, which keeps the driver's books short
    names, points = vocabulary.vocabulary, staged(vocabulary.transform(rows).select("x", *TARGETS), "bayes-points").coalesce(FIT_TASKS)
    for t in usable:
        fit = LogisticRegression(featuresCol="x", labelCol=t, regParam=penalty, elasticNetParam=1.0, standardization=False,
                                 maxIter=60, tol=1e-5).fit(points)
        weights = {names[i].encode(): float(w) for i, w in zip(*_sparse(fit.coefficients)) if w}
        out[t] |= {"weights": weights, "shift": float(fit.intercept) - out[t]["prior"]}
    return out


def _sparse(v) -> tuple:
    a = v.toArray()
    at = a.nonzero()[0]
    return at.tolist(), a[at].tolist()


def _evidence(docs: DataFrame, model: dict) -> DataFrame:
    """``id, host, path`` of ``docs`` and each target's log-likelihood ratio."""
    shared = docs.sparkSession.sparkContext.broadcast({t: (model[t]["weights"], model[t]["shift"]) for t in TARGETS})

    def step(batch: dict) -> dict:
        known = set().union(*(w for w, _ in shared.value.values()))
        found = [known & features(t) for t in batch["text"]]
        return {c: batch[c] for c in ("id", "host", "path")} | {
            t: [shift + math.fsum(w.get(f, 0.0) for f in x) for x in found] for t, (w, shift) in shared.value.items()}
    return map_texts(docs, step, f"id {id_type(docs)}, host string, path string, bad double, toxic double")


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(rates: DataFrame, rate: str, centre: Column, n: str) -> float:
    """Prior strength (in documents) from the spread of ``rate`` around ``centre`` over sites of ``n`` documents."""
    r = rates.agg(F.sum(F.col(n) * (F.col(rate) - centre) ** 2).alias("s"), F.sum(centre * (1 - centre)).alias("e"),
                  F.sum(F.col(n) * centre * (1 - centre)).alias("v"), F.sum(n).alias("n")).first()
    if not r["n"] or not r["v"]:
        return 1.0
    between = max((r["s"] - r["e"]) / r["n"], 1e-9)
    return min(max(r["v"] / r["n"] / between - 1, 1.0), 1e6)


def site_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                 path_col: str = "lang", label_id: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic",
                 sample_rows: int = 20000, max_features: int = 1 << 16, bad_from: float = 0.5, toxic_from: float = 0.3) -> DataFrame:
    """``id, host, path``, per target ``evidence_`` (log-likelihood ratio), ``prior_`` (the path's rate) and ``p_``, and ``kept``.

    One row per row of ``df``; kept if ``p_bad`` and ``p_toxic`` are below ``bad_from`` and ``toxic_from``. A null host or path is the
    empty site; a null text counts as empty. Without labels there is no evidence and every row is kept.
    Repeated rows keep a row each; an empty table gives an empty result; extra columns are ignored.
    """
    docs = pick(df, id=id_col, text=text_col, host=host_col, path=path_col) \
        .withColumns({c: F.coalesce(col(c).cast("string"), F.lit("")) for c in ("host", "path")})
    marks = pick(labels, id=label_id, quality=quality_col, toxic=toxic_col)
    model = train(labelled_sample(docs.select("id", "text"), marks, sample_rows), max_features)
    rows = staged(_evidence(docs, model), "bayes-evidence")
    p = {t: _sigmoid(F.col(t) + model[t]["prior"]) for t in TARGETS}
    paths = staged(rows.groupBy("host", "path").agg(F.count("*").alias("n"), *[F.sum(p[t]).alias(f"s_{t}") for t in TARGETS]), "bayes-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), *[F.sum(f"s_{t}").alias(f"h_{t}") for t in TARGETS])
    sites = staged(paths.join(hosts, "host"), "bayes-sites")
    whole = hosts.agg(F.sum("hn").alias("n"), *[F.sum(f"h_{t}").alias(t) for t in TARGETS]).first()
    out = salted_join(rows, sites, ["host", "path"], F.col("id"))
    fields = ["id", "host", "path"]
    low = F.lit(True)
    for t in TARGETS:
        mean = F.lit(whole[t] / whole["n"] if whole["n"] else 0.5)
        k_host = _strength(hosts.withColumn("r", F.col(f"h_{t}") / F.col("hn")), "r", mean, "hn")
        k_path = _strength(sites.withColumn("r", F.col(f"s_{t}") / F.col("n")).withColumn("c", F.col(f"h_{t}") / F.col("hn")),
                           "r", F.col("c"), "n")
        host = (k_host * mean + F.col(f"h_{t}") - p[t]) / (k_host + F.col("hn") - 1)
        path = (k_path * host + F.col(f"s_{t}") - p[t]) / (k_path + F.col("n") - 1)
        prior = F.least(F.greatest(path, F.lit(1e-6)), F.lit(1 - 1e-6))
        p_t = F.round(_sigmoid(F.col(t) + F.log(prior / (1 - prior))), 6)
        out = out.withColumns({f"prior_{t}": F.round(prior, 6), f"p_{t}": p_t})
        low = low & ((F.col(f"p_{t}") < {"bad": bad_from, "toxic": toxic_from}[t]) if model[t]["weights"] else F.lit(True))
        fields += [F.round(t, 6).alias(f"evidence_{t}"), f"prior_{t}", f"p_{t}"]
    return out.select(*fields, low.alias("kept"))
