"""The pipeline's stages against what their operators say row by row, and the rules of registration."""

import ast
from pathlib import Path

import corpus_pipeline
import pytest

import __spark_entry__ as E
from sensorflow.llm import perplexity, wfst, winnow
from sensorflow.llm.common import staged, text_key
from sensorflow.llm.queries import QUERIES, model_bytes
from tests.llm.test_operators import DOCS, SF, brute_dedup, brute_fingerprint, brute_hits, components

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def steps(spark):
    """(name, docs before, docs after) of each stage, written between as run() does."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, SF), "test-stage")
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def test_quality_rules_stage(steps):
    before, after = steps["quality_rules"]
    kept = {(r.id, r.key) for r in perplexity.quality_rules(before).filter("kept").collect()}
    assert {(r.doc_id, text_key(r.text)) for r in after.collect()} == kept
    assert after.columns == before.columns


def test_line_dedup_stage(steps):
    before, after = steps["line_dedup"]
    assert after.columns == before.columns and after.count() == before.count()
    assert after.filter("n_chars <> length(text)").count() == 0
    want = brute_dedup([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(want, key=repr) == sorted(((r.doc_id, r.text) for r in after.collect()), key=repr)
    assert after.agg({"n_chars": "sum"}).first()[0] <= before.agg({"n_chars": "sum"}).first()[0]


def test_near_dedup_stage(steps):
    before, after = steps["simhash_near_dedup"]
    fps = {r.doc_id: brute_fingerprint(r.text) for r in before.collect()}
    roots = components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(roots.values()))
    assert after.columns == before.columns


def test_decontamination_stage(spark, steps):
    before, after = steps["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {i for i, n, hit, _ in brute_hits([(r.doc_id, r.text) for r in before.collect()], items) if hit and 20 * hit >= n}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == gone
    assert after.columns == before.columns


def test_sentencepiece_stage(steps):
    before, after = steps["sentencepiece"]
    fst = wfst.compile_model(model_bytes())
    assert {r.doc_id: list(r.ids) for r in after.collect()} == {r.doc_id: list(fst.encode(r.text)) for r in before.collect()}
    assert after.filter("not round_trip").count() == 0


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a very long text, columns that clash with names used inside."""
    prose = " ".join(f"word{i % 61} and{i % 7}" for i in range(90))
    long = "\n".join(f"line {i} of a very long text with numbers {i * i}" for i in range(20000))
    rows = [(None, None, None, None), (1, "", "en", "s"), (1, "", "en", "s"), (2, " \n\t ", None, "s"), (3, prose, "en", None), (4, prose, "en", "s"),
            (4, prose, "en", "s"), (None, prose, "xx", "s"), (5, long, "de", "s"), (5, "another text of the same id", "DE", "t"), (6, None, "en", "s")]
    return staged(spark.createDataFrame([(*r, *[None] * (len(DOCS.split(",")) - 4)) for r in rows], DOCS), "odd-docs")


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_rows_and_empty_tables(spark, odd_docs, k):
    name, stage = corpus_pipeline.STAGES[k]
    for docs in (odd_docs, odd_docs.filter("false")):
        out = stage(spark, docs, SF)
        rows = out.collect()
        assert len(rows) <= docs.count()
        if k < 4:
            assert out.columns == docs.columns
    rows = stage(spark, odd_docs, SF).collect()
    texts = [r.text for r in rows] if k < 4 else []
    if name == "quality_rules":
        assert all(t and len(t.split()) >= 50 for t in texts)
    if name == "line_dedup":
        # the prose, one line of over 50 words, stays once
        assert len(rows) == odd_docs.count() and texts.count(None) == 2 and texts.count("") == 2 + 3
    if name == "simhash_near_dedup":
        assert sum(not (t or "").strip() for t in texts) == 1
    if name in ("decontamination", "sentencepiece"):
        assert len(rows) == odd_docs.count()


def test_run_returns_the_last_stage(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {r.doc_id: r.n_tokens for r in steps["sentencepiece"][1].collect()}


def test_all_are_registered():
    names = E.queries()
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "decontamination", "sentencepiece"]


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "sensorflow").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "sensorflow").parts:
            names = [n for node in ast.walk(ast.parse(path.read_text())) for n in
                     ([node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else [])]
            assert not any("llm" in n.split(".") or "corpus_pipeline" in n for n in names), path


def test_contamination_rule():
    assert winnow.gram_sizes(13) == (8, 6)
    assert all(sum(winnow.gram_sizes(n)) == n + 1 and min(winnow.gram_sizes(n)) >= 1 for n in range(1, 30))
