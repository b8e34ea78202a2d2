"""Code-point n-gram models against brute-force counts, and quality bands on texts the byte classes could not tell apart."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from sensorflow.llm import common, ngrams, perplexity


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def as_rows(grams):
    return np.array([[ord(c) for c in g] for g in grams], dtype=np.uint32)


def test_counts_and_distributions(spark):
    r = random.Random(4)
    texts = ["".join(r.choice("abж日\U0001F600 ") for _ in range(r.randrange(1, 60))) for _ in range(40)] + ["ab ab ab"] * 2
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).select("lang", "text")
    seen = ngrams.seen(ngrams.batched(docs))
    expected = Counter(("    " + t)[i:i + 5] for t in texts for i in range(len(t)))
    got = {x.gram: x.n for x in ngrams.levels(seen)[5].collect()}
    assert got == dict(expected)
    model, entropy = ngrams.estimate(seen)
    found = ngrams.Fetched(*(c.combine_chunks() for c in model.select("gram", "langs", "p", "b").toArrow().columns))
    for context in ["    ", "ab a", "ж日ab", "日日日日", "zzzz"]:
        p = np.exp(found.log_p("en", as_rows([context + c for c in "abж日\U0001F600 q"])))
        assert (p > 0).all() and abs(p[:-1].sum() + (ngrams.POINTS - 6) * p[-1] - 1) < 1e-4
    grams = [g for g, n in expected.items() for _ in range(n)]
    assert abs(-found.log_p("en", as_rows(grams)).mean() - entropy["en"]) < 1e-4


def test_noise_in_another_script_is_rejected(spark):
    r = random.Random(8)
    letters = "абвгдежзиклмнопрстуфхцчшыьюя"
    words = ["".join(r.choice(letters) for _ in range(r.randrange(3, 9))) for _ in range(150)]
    prose = [[r.choice(words) for _ in range(150)] for _ in range(80)]
    noise = [["".join(r.choice(letters) for _ in w) for w in t] for t in prose[:5]]
    rows = [(i, " ".join(t), "ru", "s") for i, t in enumerate(prose + noise)]
    kept = {x.id: x.kept for x in perplexity.quality_rules(frame(spark, rows)).collect()}
    assert not any(kept[80 + i] for i in range(5))
    assert sum(kept[i] for i in range(80)) >= 78


def test_model_grows_with_the_corpus(spark):
    """2,000 letters, which the byte classes fold to one."""
    texts = ["".join(chr(0x4E00 + (i * 977 + j * j * 31) % 2000) for j in range(400)) for i in range(40)]
    sizes = [ngrams.levels(ngrams.seen(ngrams.batched(frame(spark, [(i, t, "zh", "s") for i, t in enumerate(some)])
             .select("lang", "text"))))[5].count() for some in (texts[:10], texts)]
    assert sizes[1] > 3.5 * sizes[0]


def test_hot_noise_does_not_mask_itself(spark):
    """A third of the rows is noise of one source, a tenth copies of one noise text."""
    r = random.Random(3)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(3, 8))) for _ in range(150)]
    prose = [" ".join(r.choice(words) for _ in range(120)) for _ in range(80)]
    noise = [" ".join("".join(r.choice("QXZJqxzjkvw#@~^") for _ in range(6)) for _ in range(80)) for _ in range(41)]
    rows = [(i, t, "en-US", f"s{i % 8}") for i, t in enumerate(prose)] + [(80 + i, t, "en", "hot") for i, t in enumerate(noise[:40])]
    rows += [(120 + i, noise[40], "EN", "s1") for i in range(12)]
    out = {x.id: x for x in perplexity.quality_rules(frame(spark, rows)).collect()}
    assert {x.lang for x in out.values()} == {"en"}
    assert not any(out[i].kept for i in range(80, 132))
    assert sum(out[i].kept for i in range(80)) >= 78


def test_languages(spark):
    tags = {"en-US": "en", "zh-Hant": "zh", "deu": "deu", " FR ": "fr", "pt_BR": "pt", "": "other", "x-a": "other", "e1": "other", None: "other"}
    got = frame(spark, [(i, None, t, None) for i, t in enumerate(tags)]).select("lang", perplexity.language(perplexity.col("lang")).alias("k"))
    assert {x.lang: x.k for x in got.collect()} == tags


def test_rows_are_changed_and_dealt_to_batches_in_one_python_pass(spark):
    docs = frame(spark, [(i, "ab " * i, "en", "s") for i in range(6)]).select("doc_id", "text")
    step = lambda b: {"doc_id": b["doc_id"], "size": [len(t) for t in b["text"]], "text": b["text"]}
    out = ngrams.batched(docs, step, "doc_id bigint, size bigint, text string")
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {(r.doc_id, r.size, r.text) for r in out.collect()} == {(i, 3 * i, "ab " * i) for i in range(6)}


def test_folding_parts_early_keeps_sums_and_bounds():
    r = np.random.default_rng(3)
    parts = []
    for _ in range(5):
        h = r.integers(0, 40, 30).astype(np.uint64)
        n = r.integers(1, 9, 30)
        parts.append((h, np.stack([h, h + 1], axis=1), n, n * 3, n * 5))
    early = ngrams.folded([ngrams.folded(parts[:2]), ngrams.folded(parts[2:4]), parts[4]])
    for a, b in zip(early, ngrams.folded(parts)):
        assert (a == b).all()


def test_every_batch_is_in_one_round(spark):
    for bids in ([], [5] * 9, list(range(40)), [0] * 50 + [1 << 32] * 3 + [7 << 32, (7 << 32) + 1]):
        rows = spark.createDataFrame([(b,) for b in bids], "bid long")
        parts = [[r.bid for r in rows.filter(part).collect()] for part in perplexity.rounds(rows)]
        assert sorted(sum(parts, [])) == sorted(bids) and 1 <= len(parts) <= perplexity.ROUNDS
        assert sum(len(set(p)) for p in parts) == len(set(bids))
        if len(set(bids)) == 40:
            assert max(map(len, parts)) <= -(-40 // perplexity.ROUNDS) + 1


def test_a_batch_fetches_a_gram_once_whatever_languages_have_it(spark):
    docs = frame(spark, [(i, "the same words " * 3, tag, "s") for i, tag in enumerate(["en", "de", "fr"])]).coalesce(1)
    rows = ngrams.seen(ngrams.batched(docs.select("lang", "text"))).collect()
    fetch = Counter(r.gram for r in rows if r.fetch)
    assert set(fetch.values()) == {1} and set(fetch) == {r.gram for r in rows}
    assert sum(r.n > 0 for r in rows) > sum(r.n > 0 and r.fetch for r in rows)
    grams = [r.gram for r in rows if r.lang == "en"]
    assert grams == sorted(grams)  # sorted, they are small when written


def test_pieces_hold_few_characters():
    sizes = [ngrams.PIECE // 3] * 8 + [ngrams.PIECE * 5, 1, 2]
    runs = list(ngrams.pieces(sizes))
    assert [i for a, b in runs for i in range(a, b)] == list(range(len(sizes)))
    assert all(sum(sizes[a:b]) <= ngrams.PIECE or b - a == 1 for a, b in runs)
    assert list(ngrams.pieces([])) == []


def test_written_shuffles_and_tables_go(spark, tmp_path):
    """Under ``shuffles_removed`` a query's shuffle is forgotten when it ends; the setting comes back after it."""
    before = spark.conf.get(common.CLEANUP, None)
    held = lambda: int(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size())
    spark.sparkContext._jvm.System.gc()
    with common.shuffles_removed(spark):
        start, mark = held(), len(common.WRITTEN)
        parts = [spark.range(100).groupBy((F.col("id") % k).alias("k")).count() for k in (3, 5)]
        assert common.staged_in_turn(parts, "turns").count() == 8
        common.staged(spark.range(3), "last")
        assert held() <= start
    assert spark.conf.get(common.CLEANUP, None) == before
    first, last = common.WRITTEN[mark:]
    common.release(spark, mark, keep=1)
    assert common.WRITTEN[mark:] == [last] and spark.read.parquet(last).count() == 3
    common.release(spark, mark)
    assert len(common.WRITTEN) == mark


def test_a_worker_remembers_for_one_module_only():
    """the hashes and the compiled model of earlier stages stood beside the n-grams of a later one in every worker."""
    from sensorflow.llm import wfst, winnow
    from sensorflow.llm.queries import model_bytes

    def fill():
        winnow._word_hashes([b"some", b"words"])
        wfst._worker_model(model_bytes()).encode("some words")
        return len(winnow._hashes), wfst._worker_model.cache_info().currsize
    assert min(fill()) >= 1
    common.forget(winnow.__name__)
    assert len(winnow._hashes) and not wfst._worker_model.cache_info().currsize
    fill()
    common.forget(wfst.__name__)
    assert not len(winnow._hashes) and wfst._worker_model.cache_info().currsize
    common.forget()
    assert not len(winnow._hashes) and not wfst._worker_model.cache_info().currsize


def test_stages_forget_what_others_remember(spark):
    """in a worker that holds words of the winnowing, a task of another module leaves none; one of the winnowing keeps them."""
    from sensorflow.llm import simhash, winnow
    docs = frame(spark, [(1, "a few words of a text " * 30, "en", "s")]).coalesce(1)

    def left(batches):
        from sensorflow.llm import common as here
        import pyarrow as pa
        for _ in batches:
            pass
        words = getattr(here.MEMOS.get("sensorflow.llm.winnow"), "__self__", ())
        yield pa.RecordBatch.from_pydict({"n": [len(words)]})

    def held():  # of all workers that answer
        return max(r.n for r in spark.range(64).repartition(16).mapInArrow(left, "n long").collect())
    winnow.contamination(docs, spark.createDataFrame([(1, "a few words of a text " * 3)], "item_id long, text string")).collect()
    assert held() > 0
    many = docs.crossJoin(spark.range(64)).repartition(16)
    for _ in range(8):  # idle workers take turns
        simhash.fingerprints(many).collect()
        ngrams.seen(ngrams.batched(many.select("lang", "text"))).collect()
    assert held() == 0


def test_code_points_of_gram_arrays():
    import pyarrow as pa
    grams = ["ab", "", "ж日", "\U0001F600 ", "", "zz"]
    for kind in (pa.string(), pa.large_string()):
        a = pa.array(grams, kind)
        for part, some in ((a, grams), (a.slice(2, 3), grams[2:5]), (a.slice(1, 1), [""]), (a.slice(0, 0), [])):
            assert ngrams.unpacked(part).tolist() == [ord(c) for c in "".join(some)]
