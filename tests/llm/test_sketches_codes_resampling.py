"""Fingerprints, vector codes and importance resampling against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.llm import bottomk, gridcodes, importance
from sensorflow.llm.common import numbered, staged
from sensorflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
#: Extra columns that clash with names the operators use inside.
EXTRA = "key long, ident string, place long, sketch string, n string, edited string, vector string, code string, score string, id string"
CLASH = (1, "i", 2, "s", "n", "e", "v", "c", "s", "x")
DOCS = "doc_id long, text string, " + EXTRA


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], DOCS)


LONG = "".join(f"w{i % 977} {'x' * (i % 5)}\n" for i in range(60000))
ODD = [(None, None), (None, "null id here"), (3, ""), (3, ""), (3, "two texts of one id"), (5, " \t\n"), (6, None), (9, "Ünïcode ÄÖ 漢字 words \U0001F600 and more of them"),
       (9, "Ünïcode ÄÖ 漢字 words \U0001F600 and more of them"), (12, LONG), (-4, "a b c"), (7, "A B c")]


# ---- bottom-k sketches

def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def hashes_of(text, shingle=5):
    w = words_of(text)
    return {hashlib.md5(" ".join(w[i:i + shingle]).encode()).hexdigest()[:12] for i in range(max(len(w) - shingle, 0) + 1)} if w else set()


def near_of(a, b, k=bottomk.K):
    a, b = sorted(a)[:k], sorted(b)[:k]
    union = sorted({*a, *b})[:k]
    return len(set(union) & set(a) & set(b)) / len(union) if union else 1.0


def brute_fingerprints(rows):
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    after = {r: order[(at + 1) % len(order)][1] for at, r in enumerate(order)}
    for i, t in ((i, t or "") for i, t in rows):
        half, opening = len(t) // 2, after[i, t]
        edited = t[:len(t) - half] + opening[:half]
        a, b, c = hashes_of(t), hashes_of(edited), hashes_of(opening)
        yield (i, len(t), edited, "".join(sorted(a)[:bottomk.K]), "".join(sorted(b)[:bottomk.K]), round(near_of(a, b), 9), round(near_of(a, c), 9))


def fingerprint_rows(df):
    return [(r.id, len(r.text), r.edited, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
            for r in bottomk.fingerprints(df).collect()]


def test_fingerprints_equal_brute_force_on_odd_rows(spark):
    assert Counter(fingerprint_rows(docs_of(spark, ODD))) == Counter(brute_fingerprints(ODD))


def test_fingerprints_of_one_or_no_document(spark):
    one = [(1, "only one document of seven words here")]
    assert Counter(fingerprint_rows(docs_of(spark, one))) == Counter(brute_fingerprints(one))
    assert fingerprint_rows(docs_of(spark, [])) == []


def test_fingerprints_of_text_ids(spark):
    df = spark.createDataFrame([("b", "one two three"), ("a", "four five six"), (None, "x y"), ("", "seven eight")], "doc_id string, text string")
    got = {r.id: r.edited for r in bottomk.fingerprints(df).collect()}
    assert got == {None: "x " + "s", "": "seven " + "four ", "a": "four fi" + "one tw", "b": "one two" + "x y"}


def test_equal_texts_have_equal_fingerprints_and_estimates_are_close(spark):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(3000)]
    rows = []
    for i in range(12):
        mixed = list(base)
        for at in rng.sample(range(len(base)), 30 * i):
            mixed[at] = "changed" + str(at)
        rows.append((i, " ".join(mixed)))
    df = docs_of(spark, rows + [(99, rows[0][1])]).withColumn("s", bottomk.sketch(F.col("text")))
    pairs = df.select("doc_id", "text", "s").crossJoin(df.filter("doc_id = 0").select(F.col("s").alias("s0"))).select(
        "doc_id", "text", "s", "s0", bottomk.resemblance(F.col("s"), F.col("s0")).alias("r"), bottomk.containment(F.col("s"), F.col("s0")).alias("c"),
        bottomk.distinct_shingles(F.col("s")).alias("n")).collect()
    first = hashes_of(rows[0][1])
    for p in pairs:
        mine = hashes_of(p.text)
        assert abs(p.r - len(mine & first) / len(mine | first)) < 0.2
        assert abs(p.c - len(mine & first) / len(mine)) < 0.25
        assert abs(p.n / len(mine) - 1) < 0.3
    assert len({tuple(p.s) for p in pairs if p.doc_id in (0, 99)}) == 1


def test_merging_parts_equals_sketching_the_whole(spark):
    rng = random.Random(5)
    rows = [(g, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(30)) for _ in range(rng.randrange(0, 90))))
            for g in [1] * 60 + [2] * 3 + [None] * 2]
    rows += [(3, ""), (3, None)]
    df = spark.createDataFrame(rows, "hash long, text string").withColumn("sketch", bottomk.sketch(F.col("text")))
    got = {r["hash"]: r["sketch"] for r in bottomk.merge_sketches(df, ["hash"]).collect()}
    want = {g: sorted(set().union(*[hashes_of(t) for h, t in rows if h == g]))[:bottomk.K] for g in {g for g, _ in rows}}
    assert got == want
    two = spark.createDataFrame([(rows[0][1], rows[1][1])], "a string, b string")
    assert two.select(bottomk.merged(bottomk.sketch(F.col("a")), bottomk.sketch(F.col("b")))).first()[0] == \
        sorted(hashes_of(rows[0][1]) | hashes_of(rows[1][1]))[:bottomk.K]
    text = two.select(bottomk.from_text(bottomk.as_text(bottomk.sketch(F.col("a")))), bottomk.sketch(F.col("a")),
                      bottomk.from_text(F.lit("")), bottomk.containment(bottomk.from_text(F.lit("")), bottomk.sketch(F.col("a")))).first()
    assert text[0] == text[1] and text[2] == [] and text[3] == 1.0


def test_numbered_is_the_global_order(spark):
    rows = [(random.Random(i).randrange(50), i) for i in range(3000)] + [(None, -1)]
    df = staged(spark.createDataFrame(rows, "range_no long, i long").repartition(7), "numbered-test")
    got = [(r["place"], r["range_no"], r["i"]) for r in numbered(df, "place", "range_no", "i").orderBy("place").collect()]
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == [(n + 1, *r) for n, r in enumerate(want)]


def test_no_python_worker_in_fingerprints(spark):
    plan = QUERIES["op11_fingerprints"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---- vector codes

def brute_codes(rows, parts=4, entries=256, rounds=4):
    """Plain integers throughout; rows are (id, vector, label)."""
    rows = [r for r in rows if r[1] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    if not rows:
        return [], ""
    whole = [[max(-(1 << 50), min(1 << 50, math.floor(1024 * x))) for x in r[1]] for r in rows]
    whole = [v + [0] * (-len(v) % parts) for v in whole]
    width = len(whole[0]) // parts
    cut = [[v[p * width:(p + 1) * width] for v in whole] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for book, c in zip(books, cut):
            taken = {}
            for x in c:
                taken.setdefault(nearest(book, x)[1], []).append(x)
            for k, xs in taken.items():
                book[k] = [sum(col) // len(xs) for col in zip(*xs)]
    out, by_label = [], Counter()
    for at, r in enumerate(rows):
        found = [nearest(book, c[at]) for book, c in zip(books, cut)]
        error = min(sum(d for d, _ in found), (1 << 63) - 1)
        by_label[r[2]] += error
        out.append((r[0], "".join(f"{k:02x}" for _, k in found), error, r[2]))
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return [(i, code, error, min(by_label[label], (1 << 63) - 1)) for i, code, error, label in out], digest


VECTORS = "vec_id long, embedding array<double>, label int, " + EXTRA


def check_codes(spark, rows, **kwargs):
    df = spark.createDataFrame([(*r, *CLASH) for r in rows], VECTORS)
    got = gridcodes.vector_codes(df, **kwargs).collect()
    want, digest = brute_codes(rows, **kwargs)
    assert Counter((r.id, r.code, r.error, r.label_error) for r in got) == Counter(want)
    assert {r.codebooks_sha256 for r in got} <= {digest}


def test_codes_equal_brute_force(spark):
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 0.1) for _ in range(8)], rng.choice([1, 2, None])) for i in range(300)]
    rows += [(i + 300, rows[i % 3][1], 7) for i in range(60)]  # copies
    rng.shuffle(rows)
    check_codes(spark, rows, entries=16)


def test_codes_of_odd_vectors(spark):
    rng = random.Random(12)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], i % 3) for i in range(40)]  # does not divide by 4
    rows += [(100, None, 1), (101, [], 1), (102, [0.1] * 5 + [None], 1), (103, [float("nan")] + [0.0] * 5, 1), (104, [float("inf")] * 6, 1),
             (105, [0.5] * 7, 2), (5, [0.25] * 6, None), (5, [0.25] * 6, None), (None, [0.75] * 6, 4), (106, [1e300, -1e300, 3e9, 0.0, -0.0, 1e-300], 9)]
    check_codes(spark, rows, entries=8)
    check_codes(spark, [(1, [0.5, 0.25, 0.1, 0.0], None)])
    check_codes(spark, [])
    check_codes(spark, [(1, None, 1), (2, [None], 1)])


def test_ties_go_to_the_lower_entry(spark):
    rows = [(i, [float(i % 4)] * 4, i % 2) for i in range(40)] + [(50, [0.5] * 4, 0), (51, [2.5] * 4, 1)]
    check_codes(spark, rows, entries=12)


@pytest.mark.parametrize("edge", [1, 7, 40, 300, 5000])
def test_grid_cells_lose_no_entry(edge):
    rng = np.random.default_rng(edge)
    entries, x = rng.integers(-500, 500, (64, 5)), rng.integers(-900, 900, (700, 5))
    x[300:400] = x[0]
    find = gridcodes.Nearest(entries, edge)
    all_d = ((x[:, None, :] - entries[None]) ** 2).sum(2)
    for _ in range(2):  # the second time from memory
        best, least = find(x)
        assert (best == all_d.argmin(1)).all() and (least == all_d.min(1)).all()
    mask = find.candidates(x)
    inside = x // edge * edge + rng.integers(0, edge, x.shape)  # another point of the same cell
    assert mask[np.arange(len(x)), ((inside[:, None, :] - entries[None]) ** 2).sum(2).argmin(1)].all()
    if edge < 100:
        assert mask.mean() < 0.5


def test_cell_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(gridcodes, "CELLS", 50)
    rng = np.random.default_rng(1)
    entries, x = rng.integers(-500, 500, (32, 4)), rng.integers(-900, 900, (600, 4))
    find = gridcodes.Nearest(entries, 20)
    got = np.concatenate([find(x[i:i + 40])[0] for i in range(0, 600, 40)])
    assert len(find.cells) <= 50 and (got == ((x[:, None, :] - entries[None]) ** 2).sum(2).argmin(1)).all()


# ---- importance resampling

def features_of(text, n=1):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return [" ".join(w[i:i + m]) for m in range(1, n + 1) for i in range(len(w) - m + 1)], len(w)


def brute_resample(rows, target, percent=10, n=1, min_words=20):
    def buckets(text):
        return [zlib.crc32(f.encode()) % 10000 for f in features_of(text, n)[0]]
    s, t = Counter(b for _, x in rows for b in buckets(x)), Counter(b for x in target for b in buckets(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    out = []
    for i, x in rows:
        f = buckets(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, features_of(x)[1]])
    able = [r for r in out if r[5] >= min_words]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = place + 1
    return [tuple(r[:5]) for r in out]


def resampled(df, target, **kwargs):
    return [tuple(r) for r in importance.resample(df, target, **kwargs).select("id", "n_features", "weight", "score", "rank").collect()]


def test_resample_equals_brute_force(spark):
    rng = random.Random(2)
    words = ["alpha", "Beta", "gamma", "delta7", "éclair", "漢字", "omega", "x"]
    rows = [(i, ", ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(400)] + ODD
    target = ["alpha beta " * 30, None, "", "omega"]
    df, bench = docs_of(spark, rows), spark.createDataFrame([(t,) for t in target], "text string")
    assert Counter(resampled(df, bench)) == Counter(brute_resample(rows, target))
    assert Counter(resampled(df, bench, percent=100, max_words=3, min_words=0)) == Counter(brute_resample(rows, target, 100, 3, 0))
    assert Counter(resampled(df, bench.filter("false"), percent=0)) == Counter(brute_resample(rows, [], 0))
    assert resampled(docs_of(spark, []), bench) == []


def test_resample_draws_exactly_among_ties(spark):
    """A third of all rows repeat one id and text, so the cutoff falls among rows that no column tells apart."""
    text = "one two three four five six seven eight nine ten " * 3
    rows = [(i, text) for i in range(60)] + [(7, text)] * 120
    got = resampled(docs_of(spark, rows), spark.createDataFrame([("one",)], "text string"), percent=50)
    assert Counter(got) == Counter(brute_resample(rows, ["one"], 50))
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 91))


@pytest.mark.parametrize("n", [0, 1, 2, 5, 499, 500])
def test_threshold_bisection_takes_the_first_rows(spark, n):
    rows = [(random.Random(i).choice([-(1 << 62), -3, 0, 4, 1 << 62]), i % 7, i) for i in range(500)]
    table = staged(spark.createDataFrame(rows, "a long, b int, c long"), "bisect-test")
    got = table.filter(importance.first_rows(table, n, ["a", "b", "c"])).collect()
    assert sorted(map(tuple, got)) == sorted(rows)[:n]


def test_resample_wants_integer_ids(spark):
    with pytest.raises(ValueError):
        importance.resample(spark.createDataFrame([("a", "b")], "doc_id string, text string"), spark.createDataFrame([("x",)], "text string"))


# ---- the registered queries

@pytest.mark.parametrize("name", ["op11_fingerprints", "op12_vector_codes", "op13_importance_resampling"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})")
    types = {T.LongType(): "BIGINT", T.StringType(): "VARCHAR", T.DoubleType(): "DOUBLE"}
    assert [types[df.schema[c].dataType] for c in cols] == [str(d[1]) for d in want.description]
    assert Counter(map(tuple, df.select(*cols).collect())) == Counter(want.fetchall())
