"""Stages of the pipeline on odd and empty tables, against plain code where it is short, and all of them in a row."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline as pipeline
from bazaarlens.llm import toxicity
from bazaarlens.llm.ngram_join import ngram_components
from bazaarlens.llm.shingles import words

TESTDATA = os.environ.get("BAZAARLENS_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")
NAMES = [name for name, _ in pipeline.STAGES]


def test_stages_are_those_asked_for():
    assert NAMES == ["quality rules", "line dedup", "near dedup", "decontamination", "packing"]


@pytest.mark.parametrize("name", NAMES)
def test_stage_on_odd_and_empty_tables(spark, odd, none, name):
    stage = dict(pipeline.STAGES)[name]
    found = stage(spark, odd, TESTDATA)
    assert stage(spark, none, TESTDATA).count() == 0
    if name == "packing":
        assert found.select("doc_id").distinct().count() <= odd.select("doc_id").distinct().count()
        return
    assert found.columns == odd.columns
    rows = [r["text"] for r in found.collect()]
    if name == "quality rules":
        assert None not in rows and "" not in rows and "x" not in rows
    if name == "line dedup":
        assert len(rows) == odd.count()
    if name == "near dedup":
        assert sum(t is not None and t.startswith("same0") and "\n" not in t for t in rows) == 1
    if name == "decontamination":
        assert len(rows) == odd.count()


def test_all_stages_against_their_rules(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    items = [words(r["text"].encode()) for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect() if r["text"]]
    windows = {tuple(w[k : k + 10]) for w in items if w for k in range(max(1, len(w) - 9))}
    kept = docs
    for name, stage in pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, TESTDATA)
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        assert 0 < kept.count() <= before.count() and kept.columns == docs.columns
        assert kept.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
        if name == "near dedup":
            # No two of what is left have nearly the same words in nearly the same order.
            alike = ngram_components(kept, words=5, percent=95)
            assert alike.where("n_shingles > 20 and component_id <> id").isEmpty()
        if name == "decontamination":
            for row in kept.collect():
                own = words(row["text"].encode())
                assert not any(tuple(own[k : k + 10]) in windows for k in range(len(own)))
    packed = pipeline.STAGES[-1][1](spark, kept, TESTDATA).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in kept.collect()}
    fill = {}
    for r in packed:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) * 1.1 + 1


def test_spans_are_places_of_the_text_itself():
    """A letter that is two in lower case moves nothing."""
    text = "İİİ vile words, VILE"
    _, spans = toxicity.tag(text, toxicity._Levels({"=vile": 5.0, "vile": 5.0}), toxicity.Model())
    assert [text[s:e] for s, e, _ in spans] == ["vile", "VILE"]
