"""Rows whose id and text read alike when joined are still different rows."""

from __future__ import annotations

import pytest

from bazaarlens.llm.decontamination import decontaminate
from bazaarlens.llm.line_dedup import line_dedup
from bazaarlens.llm.near_dedup import near_dedup
from bazaarlens.llm.text import KEY, row_key

WORDS = " ".join(f"word{k}" for k in range(30))


@pytest.fixture(scope="module")
def alike(spark):
    rows = [("a:b", f"c {WORDS}"), ("a", f"b:c {WORDS}"), ("x", None), ("x", "-"), (None, "1:x+q"), ("1", "x+q"), (None, "-"), ("-", None)]
    return spark.createDataFrame(rows, "doc_id string, text string")


def test_keys_differ(alike):
    keys = row_key(alike, "doc_id", "text")
    assert keys.select(KEY).distinct().count() == alike.count()


def test_near_dedup_keeps_different_rows(spark):
    rows = [("a:b", f"c {WORDS}"), ("a", "b:c other words entirely"), ("x", None), ("x", "-")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert sorted(near_dedup(df).collect(), key=str) == sorted(df.collect(), key=str)


def test_each_row_has_its_own_result(spark, alike):
    lines = {(r["doc_id"], r["n_lines"], r["text"]) for r in line_dedup(alike).collect()}
    assert len(lines) == alike.count()
    items = spark.createDataFrame([("i", f"b {WORDS}")], "item_id string, text string")
    hits = {r["doc_id"]: r["n_hit"] for r in decontaminate(alike.where("doc_id like 'a%'"), items).collect()}
    assert hits == {"a:b": 30, "a": 30} or hits == {"a:b": 30, "a": 31}
