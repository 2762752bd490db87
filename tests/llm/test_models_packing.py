from __future__ import annotations

import hashlib
import os
import random
import re
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from bazaarlens.llm import quality_classifier, secrets, toxicity
from bazaarlens.llm.labels import held_out, training_rows
from bazaarlens.llm.packing import Plan, pack

TESTDATA = os.environ.get("BAZAARLENS_TESTDATA", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")
tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def sequences(counts, capacity):
    """What the plan puts where: checks that it is complete, gapless and within the capacity."""
    plan, places, done = Plan(dict(counts), capacity), {}, {}
    for size, first, n, sequence, each, offset in plan.rows:
        assert first == done.get(size, 0)
        done[size] = first + n
        for k in range(n):
            places.setdefault(sequence + k // each, []).append((offset + k % each * size, size))
    assert done == {k: v for k, v in counts.items() if v} and len(places) == plan.sequences
    for items in places.values():
        at = 0
        for offset, size in sorted(items):
            assert offset == at
            at += size
        assert at <= capacity
    return plan


def best_fit(counts, capacity):
    rooms = []
    for size in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
        fitting = [r for r in rooms if r >= size]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - size)
        else:
            rooms.append(capacity - size)
    return len(rooms)


def least(items, capacity, rooms=()):
    """Fewest sequences, by trying everything."""
    if not items:
        return len(rooms)
    first, rest = items[0], items[1:]
    options = {r for r in rooms if r >= first}
    found = [least(rest, capacity, (*rooms[: rooms.index(r)], r - first, *rooms[rooms.index(r) + 1 :])) for r in options]
    return min([*found, least(rest, capacity, (*rooms, capacity - first))])


def test_plan_is_sound_and_no_worse_than_best_fit():
    dice = random.Random(1)
    for _ in range(200):
        capacity = dice.choice([5, 10, 30, 100])
        counts = {dice.randint(1, capacity): dice.randint(1, 20) for _ in range(dice.randint(0, 12))}
        assert sequences(counts, capacity).sequences <= best_fit(counts, capacity)


def test_what_reduction_fixes_is_part_of_a_best_packing():
    dice = random.Random(2)
    for _ in range(60):
        items = sorted((dice.randint(1, 12) for _ in range(7)), reverse=True)
        plan = Plan({s: items.count(s) for s in items}, 12)
        reduced = Plan.__new__(Plan)
        reduced.capacity, reduced.left = 12, {s: items.count(s) for s in items}
        reduced.done, reduced.sequences, reduced.fixed, reduced.rows = dict.fromkeys(reduced.left, 0), 0, 0, []
        reduced._reduce()
        rest = [s for s, n in sorted(reduced.left.items(), reverse=True) for _ in range(n)]
        assert reduced.fixed + least(rest, 12) == least(items, 12) <= plan.sequences


def by_tokenizer(text):
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check_packing(docs, found, capacity):
    texts = {(r["doc_id"], r["text"]): by_tokenizer(r["text"]) for r in docs.collect()}
    by_id = {}
    for (i, _), ids in texts.items():
        by_id.setdefault(i, []).append(ids)
    rows, filled = found.collect(), {}
    for r in rows:
        parts = [ids[r["start"] : r["start"] + r["length"]] for ids in by_id[r["doc_id"]]]
        assert r["ids_crc32"] in {zlib.crc32(np.array(p, "<u4").tobytes()) for p in parts}
        assert r["start"] == r["piece"] * capacity and r["length"] <= capacity
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in filled.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(r["length"] for r in rows) == sum(len(by_tokenizer(r["text"])) for r in docs.collect())
    return len(filled), -(-sum(r["length"] for r in rows) // capacity)


def test_packing_odd_rows(odd, none):
    n, bound = check_packing(odd, pack(odd, PATH, 512), 512)
    assert n <= bound + 1
    assert pack(none, PATH).count() == 0
    ids = pack(odd.where("doc_id = 8"), PATH, with_ids=True).first()["ids"]
    assert ids == by_tokenizer("Ünï ÉCOLE — ﬁn")


def test_words_one_by_one_are_the_whole_text(documents):
    text = "don 't  ' s\n<|endoftext|>x 12Ünï é ＡＢ\x1c  Σ'S ́a 1234 ... it's"
    assert pack(documents([(1, text)]), PATH, with_ids=True).first()["ids"] == by_tokenizer(text)


@needs_tables
def test_packing_of_the_test_table(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    n, bound = check_packing(docs, contract.queries()["op10_packing"](spark, TESTDATA), 2048)
    assert n <= 1.01 * bound + 1


def plain_spans(text):
    """The contract's patterns, matched and dropped as it is written."""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(f"(?ai:{assign})", text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_base_secrets_against_plain_code(documents):
    dice = random.Random(7)
    bits = ["password", "Token", "api_key", "APIKEY", ": ", "=", "'", '"', " ", "abcdef", "AKIA", "ABCD1234EFGH5678", "0123456789abcdef", "é", "\n", "=="]
    texts = [None, "", "ſecret: abcdefgh", "password: token: abcdefgh", "secret='x'", "AKIA" * 6, "f" * 23, "f" * 24, "toKen=abcdefgh"]
    texts += ["".join(dice.choices(bits, k=14)) for _ in range(300)]
    found = {r["doc_id"]: r for r in secrets.find_secrets(documents(list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        spans = plain_spans(text or "")
        assert found[k]["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(found[k]["spans"].split(","))
        assert [found[k][f"n_{x}"] for x in ("assign", "access", "hex")] == [spans.count(f"{x}:") for x in ("assign", "access", "hex")]


def test_novel_strings_in_sensitive_places(documents):
    dice = random.Random(3)
    random_string = "".join(dice.choices(string.ascii_letters + string.digits, k=40))
    pairs = [
        (1, f"Authorization header with bearer {random_string} for the client"),
        (2, f"nothing of note {random_string} in this place"),
        (3, "the secret is xyzxyz1212xyzxyz1212xyzxyz1212xyzxyz1212 in plain sight"),
        (4, f"see {random_string} above; the session id is {random_string} again"),
        (5, "an author wrote authentication123 in the text"),
    ]
    spans = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(documents(pairs)).collect()}
    at = pairs[0][1].index(random_string)
    assert spans[1] == f"novel:{at}:{at + 40}"
    # A string that stands twice is found where it is in a sensitive place, whatever stands around.
    again = pairs[3][1].rindex(random_string)
    assert spans[4] == f"novel:{again}:{again + 40}"
    assert [spans[k] for k in (2, 3, 5)] == [""] * 3


def test_novel_spans_against_plain_code():
    """Candidates one by one, against every taken span."""
    dice = random.Random(5)
    word = lambda n: "".join(dice.choices(string.ascii_letters + string.digits, k=n))
    for _ in range(40):
        parts = []
        for _ in range(30):
            parts.append(dice.choice([f"token {word(30)}", f"password={word(20)}", word(16), "f0" * 13, "some words here", f"bearer {'ab12' * 8}", "é" * 9]))
        text = dice.choice([" ", "\n"]).join(parts)
        taken = secrets.base_spans(text)
        want = []
        for m in secrets._CANDIDATE.finditer(text):
            own = m[0]
            mixed = any(c.isdigit() for c in own) and any(c.isalpha() for c in own)
            if not mixed or any(s < m.end() and m.start() < e for s, _, e in taken):
                continue
            near = secrets._SENSITIVE.search(text, max(0, m.start() - secrets.BEFORE), m.start())
            follows = want and secrets._NEXT_LINE.fullmatch(text, want[-1][2], m.start())
            if (near or follows) and secrets.novelty(text, *m.span()) >= secrets.NOVELTY:
                want.append((m.start(), "novel", m.end()))
        assert secrets.novel_spans(text, taken, secrets.NOVELTY) == want


def test_many_hashes_take_time_in_proportion():
    import time

    dice = random.Random(2)
    lines = [f"{k} secret {''.join(dice.choices('0123456789abcdef', k=40))}" for k in range(60_000)]
    began = time.process_time()
    text = "\n".join(lines)
    assert secrets.novel_spans(text, secrets.base_spans(text), secrets.NOVELTY) == []
    assert time.process_time() - began < 20


def test_every_line_of_a_private_key_is_reported():
    dice = random.Random(11)
    lines = ["".join(dice.choices(string.ascii_letters + string.digits + "+/", k=k)) for k in (64, 64, 64, 64, 64, 64, 9)]
    for between in ("\n", "\r\n", "\n    ", '" +\n    "'):
        text = f"text before{between}-----BEGIN RSA PRIVATE KEY-----{between}{between.join(lines)}={between}-----END RSA PRIVATE KEY-----{between}after it"
        found = [text[s:e] for s, _, e in secrets.novel_spans(text, [], 0.75)]
        assert found == [*lines[:-1], lines[-1] + "="]
    assert secrets.novel_spans(f"the words{chr(10)}{chr(10).join(lines)}", [], 0.75) == []


def test_secrets_odd_rows(odd, none):
    found = secrets.find_secrets(odd)
    assert found.count() == odd.count() and found.where("spans <> ''").count() == 0
    assert secrets.find_secrets(none).count() == 0


def test_held_out_rows_are_never_learned_from(spark, documents):
    rows = [(k, k % 2, 0) for k in range(400)] + [(None, 1, 0), (5, None, 0)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    docs = documents([(k, f"text {k}") for k in range(400)])
    out = {k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2}
    assert {r["doc_id"] for r in docs.where(held_out(F.col("doc_id"))).collect()} == out
    picked = training_rows(docs, labels, "quality", 10_000).collect()
    assert {r["doc_id"] for r in picked} == set(range(400)) - out
    assert training_rows(docs, labels, "quality", 7).count() == 7


def writing(spark, n=800):
    """Two kinds of text for each label."""
    dice, rows = random.Random(5), []
    for k in range(n):
        words = ["".join(dice.choices("abcdefghij", k=dice.randint(2, 9))) for _ in range(dice.randint(20, 80))]
        good, toxic = int(k % 5 > 1), int(k % 4 == 1)
        if toxic:
            for _ in range(3):
                words.insert(dice.randint(0, len(words)), dice.choice(["vile", "schuftig" + dice.choice("abc"), "schuftig"]))
        text = " ".join(words) if good else " ".join(w for w in words for _ in range(3)) if k % 5 else "*** ".join(words)
        rows.append((k, text, good, toxic))
    return spark.createDataFrame(rows, "doc_id bigint, text string, quality int, toxic int")


def accuracy(scored, rows, label, threshold):
    return scored.join(rows, "doc_id").select(F.avg(((F.col("score") >= threshold).cast("int") == F.col(label)).cast("double"))).first()[0]


def test_quality_of_rows_not_learned_from(spark, odd, none):
    rows = writing(spark)
    model = quality_classifier.train(rows.where("doc_id % 20 < 15"))
    test = rows.where("doc_id % 20 >= 15")
    assert accuracy(quality_classifier.score(test.select("doc_id", "text"), model), test, "quality", 0.7) > 0.95
    found = quality_classifier.score(odd, model)
    assert found.count() == odd.count() and found.where("score between 0 and 1").count() == odd.count()
    assert quality_classifier.score(none, model).count() == 0


def test_quality_without_both_labels(spark, odd):
    rows = writing(spark, 60)
    for label, share in ((1, 1.0), (0, 0.0), (None, 0.5)):
        model = quality_classifier.train(rows.withColumn("quality", F.lit(label).cast("int")))
        assert {r["score"] for r in quality_classifier.score(odd, model).collect()} == {share}


def test_calibration_never_falls():
    dice = np.random.default_rng(1)
    x, y = np.sort(dice.random(50)), dice.random(50)
    at, chances = quality_classifier.isotonic(x, y, np.ones(50))
    assert (np.diff(chances) >= 0).all() and (np.diff(at) >= 0).all()
    assert np.average(np.interp(x, at, chances)) == pytest.approx(y.mean())


def test_toxic_rows_not_learned_from(spark, odd, none):
    rows = writing(spark)
    model = toxicity.train(rows.where("doc_id % 20 < 15"))
    test = rows.where("doc_id % 20 >= 15")
    scored = toxicity.score(test.select("doc_id", "text"), model)
    assert accuracy(scored, test, "toxic", 0.3) > 0.97
    for r in scored.join(test, "doc_id").where("toxic = 1").collect():
        assert {r["text"][s["start"] : s["end"]][:4] for s in r["spans"]} <= {"vile", "schu"} and r["spans"]
    found = toxicity.score(odd, model)
    assert found.count() == odd.count() and found.where("score between 0 and 0.3").count() == odd.count()
    assert toxicity.score(none, model).count() == 0
    assert toxicity.score(odd, toxicity.train(rows.where("toxic = 0"))).where("score >= 0.3").count() == 0


def test_marginals_of_a_sparse_chain_are_those_of_the_whole_chain():
    dice = np.random.default_rng(4)
    for _ in range(20):
        n = int(dice.integers(1, 40))
        model = toxicity.Model({}, dice.normal(0, 2, toxicity.LEVELS), dice.normal(0, 1, (2, 2)))
        levels = np.where(dice.random(n) < 0.3, dice.integers(1, toxicity.LEVELS, n), 0)
        own, turn = np.stack([np.ones(n), np.exp(model.emission[levels])], 1), np.exp(model.turn)
        forward, backward = [own[0]], [np.ones(2)]
        for t in range(1, n):
            forward.append((forward[-1] @ turn) * own[t])
        for t in range(n - 2, -1, -1):
            backward.insert(0, turn @ (own[t + 1] * backward[0]))
        both = np.array(forward) * np.array(backward)
        at = np.flatnonzero(levels)
        if len(at):
            assert toxicity.chain_marginals(levels[at], at, n, model) == pytest.approx((both[:, 1] / both.sum(1))[at])


@needs_tables
@pytest.mark.parametrize("name", ["op3_quality_classifier", "op6_quality_rules", "op7_secrets", "op9_toxicity"])
def test_query_has_a_row_for_each_document(spark, name):
    found = contract.queries()[name](spark, TESTDATA)
    n = spark.read.parquet(f"{TESTDATA}/documents.parquet").count()
    assert found.select("doc_id").distinct().count() == found.count() == n
