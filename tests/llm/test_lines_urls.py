from __future__ import annotations

import hashlib
import os
import string
from collections import defaultdict

import pytest

import __spark_entry__ as contract
from bazaarlens.llm.line_dedup import line_dedup
from bazaarlens.llm.oracle import ORACLE
from bazaarlens.llm.url_filter import url_filter
from check import connect, difference

TESTDATA = os.environ.get("BAZAARLENS_TESTDATA", "/root/testdata/sf0.001")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: Operators that may run Python in tasks.
FREE = {"op11_ngram_join", "op13_prefix_trie"}
SPACES = " \t\n\x0b\x0c\r"


@pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")
@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    df = contract.queries()[name](spark, TESTDATA)
    assert difference(df, connect(TESTDATA), ORACLE[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    python = () if name in FREE else ("EvalPython", "MapInArrow", "MapInPandas")
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", *python):
        assert unwanted not in plan


def by_hand(pairs, min_chars=40, min_documents=5):
    holders = defaultdict(set)
    key = lambda line: line.strip(SPACES).translate(LOWER)
    for i, text in pairs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, text in pairs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders[key(x)]) >= min_documents and i != max(holders[key(x)]))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def test_line_dedup_against_plain_code(documents):
    shared = "This line is shared by many documents, and long enough é"
    pairs = [(k, f"own {k}\n{'  ' if k % 2 else ''}{shared.upper() if k == 3 else shared}\t\n\nend") for k in range(6)]
    pairs += [(7, f"{shared}\nx\n{shared}"), (8, "short\n" * 50), (9, None), (10, ""), (11, shared.replace("é", "É"))]
    pairs += [(k, "Only four documents hold this line of forty characters or more") for k in range(20, 24)]
    found = line_dedup(documents(pairs)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, found)) == by_hand(pairs)


def test_line_dedup_odd_rows(odd, none):
    found = line_dedup(odd)
    assert found.count() == odd.count()
    assert set(found.columns) == {*odd.columns, "n_dropped"}
    rows = {r["doc_id"]: r for r in found.where("doc_id in (1, 2, 3)").collect()}
    assert [rows[k]["text"] for k in (1, 2, 3)] == ["", "", " \n\t\n"]
    assert [rows[k]["n_lines"] for k in (1, 2, 3)] == [1, 1, 3]
    assert line_dedup(none).count() == 0


def test_line_of_null_ids_only_stays(documents):
    line = "a line that only documents without any id happen to hold, five times"
    assert line_dedup(documents([(None, line)] * 5)).where("text = ''").count() == 0
    kept = line_dedup(documents([(None, line)] * 5 + [(1, line)])).where("text <> ''").collect()
    assert [r["doc_id"] for r in kept] == [1]


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("x.org", "", "block"), ("x.org", "/", "allow"), ("x.org", "/", "block")]


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut].translate(LOWER), rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), h + p, v == "block") for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[1], "allow" if best is None or not best[2] else "block"


def test_url_filter_against_plain_code(spark):
    urls = [
        None, "", "no scheme/com/", "http://", "http:///path", "HTTP://WWW.Example.COM/en/1?x=://y", "https://a.example.com/en/2#t",
        "https://example.com/en", "https://notexample.com/en/1", "ftp://x.org", "ftp://deep.below.x.org/?q", "http://x.org?q", "http://com/",
        "http://com", "http://a.com.", "http://É.com/é/", "http://example.com/EN/", "http://user@x.org:80/",
    ] * 2
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter(pages, rules).collect()}
    assert found == {k: judged(u) for k, u in enumerate(urls)}
    assert url_filter(pages.limit(0), rules).count() == 0
    free = url_filter(pages.selectExpr("*", "'x' as host", "1 as rule"), rules.limit(0), default="block")
    assert {r["verdict"] for r in free.collect()} == {"block"} and free.count() == len(urls)


def test_digest_of_kept_text(spark, documents):
    text = "é\nx"
    assert hashlib.sha256(line_dedup(documents([(1, text)])).first()["text"].encode()).hexdigest() == hashlib.sha256(text.encode()).hexdigest()
