"""The pipeline against a plain version of its decisions on the small tables."""

from __future__ import annotations

import hashlib
import importlib

import __spark_entry__

from .test_text_operators import brute_groups, stats

SF = "/root/testdata/sf0.001"


def test_pipeline_rows(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns
    failed = {r.doc_id for r in docs.collect() for s in [stats(r.text)] if s[0] < 50 or 100 * s[4] > 50 * s[0]}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & failed and (good - failed) <= ids
    once = pipeline.near_duplicates(spark, kept, SF)
    rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in once.collect()) == sorted(d for d, _, c in brute_groups(rows) if c == d)
    mixed = pipeline.mixing(spark, once, SF)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} == {r.doc_id for r in once.collect()}
    assert pipeline.run(spark, SF).count() == mixed.count()


def test_one_row_of_each_group_stays(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(2, a, "en", "s", 1), (2, a, "en", "s", 1), (2, a, "de", "s", 1), (None, b, "en", "s", 1), (None, b, "en", "s", 1),
            (5, a, "en", "s", 1), (5, c, "en", "s", 1), (None, c, "en", "s", 1), (7, "", "en", "s", 1), (7, "", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = sorted((tuple(r)[:3] for r in pipeline.near_duplicates(spark, docs, SF).collect()), key=str)
    assert out == sorted([(2, a, "de"), (None, b, "en"), (5, c, "en"), (7, "", "en"), (7, "", "en")], key=str)


def test_stages_on_odd_rows(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(80))
    rows = [(1, words(1), "en", "s", 1), (1, words(1), "en", "s", 1), (None, words(2), None, None, None), (2, None, "en", "s", 0), (3, "", "en", "s", 0),
            (4, words(4) + " " + "long " * 3 + " ".join(f"z{i}" for i in range(60_000)), "en", "t", 9), (5, words(5), "en", "t", 1), (6, words(5), "de", "t", 1)]
    docs = spark.createDataFrame([(*r, "x", True, 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept boolean, epoch int")
    once = pipeline.quality(spark, docs, SF)
    assert once.columns == list(pipeline.COLUMNS) and {r.doc_id for r in once.select("doc_id").collect()} <= {1, None, 4, 5, 6}
    mixed = pipeline.mixing(spark, docs, SF)
    assert mixed.columns == list(pipeline.COLUMNS) and mixed.select("doc_id", "text").distinct().count() == 7 and mixed.count() >= 8
    out = pipeline.tokens(spark, docs, SF).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert len(out) == 8 and all((r.n_tokens == 0) == (r.doc_id in (2, 3)) == (r.decoded_sha256 == nothing) for r in out)
    assert next(r for r in out if r.doc_id == 4).decoded_sha256 == hashlib.sha256(rows[5][1].encode()).hexdigest()
    empty = docs.limit(0)
    for name, step in pipeline.STAGES:
        assert step(spark, empty, SF).count() == 0, name


def test_a_task_of_tokens_holds_one_python_process(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    rows = [(1, "one text and  another", "s"), (None, None, None), (1, "", "t"), (1, "", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = pipeline.tokens(spark, docs, SF)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    known = {r.decoded_sha256 for r in out.collect()}
    assert out.count() == 4 and known == {hashlib.sha256((t or "").encode()).hexdigest() for _, t, _ in rows}


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
