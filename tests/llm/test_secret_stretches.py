"""Random strings that a score over whole runs would lose."""

import random
import re

from pyspark.sql import functions as F

from sensorflow.llm import secret_scan

SF = "/root/testdata/sf0.001"


def test_random_strings_behind_ordinary_words(spark):
    r = random.Random(6)
    real = spark.read.parquet(f"{SF}/documents.parquet")
    samples = secret_scan.labelled_samples(real.select(F.col("doc_id").alias("id"), "text"), 50, 300)
    words = [w for t in real.filter("lang = 'en'").limit(30).collect() for w in re.findall("[a-z]{4,}", t.text)]
    key = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    path = lambda n: "/".join(r.choice(words) for _ in range(n))
    texts, found, ends = [], [], []
    for n in (4, 8):
        for size in (20, 24, 32, 40):
            for _ in range(25):
                lead = path(n) + "/"
                texts.append(f"x {lead}{''.join(r.choice(key) for _ in range(size))}/{path(2)} y")
                ends.append((n, size, 2 + len(lead), 2 + len(lead) + size))
    plain = [f"x {path(10)} y" for _ in range(100)]
    cut = [f"x {path(2)}/{'0a' * 20}/{path(2)}/{''.join(r.choice(key) for _ in range(40))} y" for _ in range(25)]
    df = spark.createDataFrame(list(enumerate(texts + plain + cut)), "doc_id long, text string")
    out = {x.id: [(s.s, s.e) for s in x.spans if s.k == 3] for x in secret_scan.secret_spans(df, samples=samples).collect()}
    share = {}
    for i, (n, size, a, z) in enumerate(ends):
        hit = any(min(z, e) - max(a, s) >= 0.7 * size for s, e in out[i])
        share.setdefault((n, size), []).append(hit)
    share = {k: sum(v) / len(v) for k, v in share.items()}
    print(share, sum(map(bool, (out[200 + i] for i in range(100)))), sum(map(bool, (out[300 + i] for i in range(25)))))
    assert min(share.values()) >= 0.75 and min(v for (_, size), v in share.items() if size >= 32) >= 0.95
    assert sum(bool(out[200 + i]) for i in range(100)) <= 2
    assert sum(bool(out[300 + i]) for i in range(25)) >= 24


def test_long_texts_are_linear(spark):
    """A megabyte of matches, and one run of half a megabyte with thousands of stretches, within seconds; also against small pieces."""
    import time
    samples = spark.createDataFrame([(1, "aK3f9Qz81LmsX0pR7tB2vN" * 2)] * 50 + [(0, "hello_world_name_of_the_thing")] * 50, "label int, token string")
    unit = "token=abcdefgh1 \n"
    run = "hello_world_name_of_the_thing_and_more_words_" * 4 + "aK3f9Qz81LmsX0pR7tB2vN"
    texts = [unit * 60000, unit * 3, run * 2500, run * 2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.time()
    got = {r.id: [tuple(x) for x in r.spans] for r in secret_scan.secret_spans(df, samples=samples).collect()}
    assert time.time() - began < 60
    size = len(unit)
    assert got[0] == [(size * i, 0, size * i + size - 2) for i in range(60000)]
    assert got[1] == got[0][:3]
    two = len(run)
    assert len(got[2]) > 2000 and [(s % two, e % two) for s, _, e in got[2][5:50]] == [(s % two, e % two) for s, _, e in got[2][50:95]]


def test_query_counts_every_kind_wherever_its_spans_stand(spark, tmp_shared):
    from sensorflow.llm.queries import QUERIES
    assign, access, hexes = "password=abcdefgh1 ", "AKIAABCDEFGH1234 ", "0a" * 16 + " "
    texts = {1: (access, (0, 1, 0)), 2: (hexes * 3, (0, 0, 3)), 3: (hexes + access + assign * 2, (2, 1, 1)), 4: (assign * 4, (4, 0, 0)),
             5: (None, (0, 0, 0)), 6: (access * 5 + "secret: short", (0, 5, 0))}
    root = tmp_shared("secrets")
    spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string").write.parquet(f"{root}/documents.parquet")
    out = {r.doc_id: (r.n_assign, r.n_access, r.n_hex) for r in QUERIES["op1_secret_scan"](spark, root).collect()}
    assert out == {i: n for i, (_, n) in texts.items()}
