from __future__ import annotations

import os
import random
import re
import time
from itertools import combinations, count

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as contract
from bazaarlens.llm import components as linked
from bazaarlens.llm import near_dedup as near
from bazaarlens.llm import ngram_join, substring_dedup
from bazaarlens.llm.components import components
from bazaarlens.llm.shingles import shingles, words
from bazaarlens.llm.substring_dedup import compact_windows, passages, repeated_passages

TESTDATA = os.environ.get("BAZAARLENS_TESTDATA", "/root/testdata/sf0.001")


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_against_plain_code(spark):
    dice = random.Random(1)
    links = [(dice.randint(0, 300), dice.randint(0, 300)) for _ in range(180)]
    links += [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 560)] + [(7, 7), (3, None)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    true = [(a, b) for a, b in links if b is not None and a != b]
    assert found == roots({n for pair in true for n in pair}, true)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def counting(monkeypatch, module, name):
    """The results of every call of the module's function from here on."""
    calls, own = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *args: calls.append(own(*args)) or calls[-1])
    return calls


def test_components_of_stars_take_no_further_round(spark, monkeypatch):
    tables = counting(monkeypatch, linked, "written")
    stars = [(k % 5, k) for k in range(5, 60)] + [(70, 70)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(stars, "a bigint, b bigint")).collect()}
    assert found == {k: k % 5 for k in range(60)} and len(tables) == 1


def test_components_of_the_same_links_are_found_once(documents, corpus, monkeypatch):
    once, again = counting(monkeypatch, near, "components"), counting(monkeypatch, ngram_join, "components")
    near.near_classes(documents(corpus)).count()
    assert len(once) == 1 and len(again) <= 1


def weighted_jaccard(a, b, idf):
    (fa, wa), (fb, wb) = near.weighted(a, idf), near.weighted(b, idf)
    one, two = dict(zip(fa.tolist(), wa.tolist())), dict(zip(fb.tolist(), wb.tolist()))
    shared = sum(min(w, two[k]) for k, w in one.items() if k in two)
    whole = sum(one.values()) + sum(two.values()) - shared
    return shared / whole if whole else 0.0


def by_hand(pairs, idf, similarity=0.8):
    """Classes from all pairs that share a shingle."""
    texts = {i: (t or "").encode() for i, t in pairs}
    holders = {}
    for i, t in texts.items():
        for s in set(shingles(words(t)).tolist()):
            holders.setdefault(s, []).append(i)
    near_pairs = {p for own in holders.values() for p in combinations(sorted(own), 2)}
    links = [p for p in near_pairs if weighted_jaccard(texts[p[0]], texts[p[1]], idf) >= similarity]
    return roots(texts, links)


def edited(text, dice, share):
    return " ".join(w if dice.random() > share else f"new{dice.randint(0, 10**6)}" for w in text.split())


@pytest.fixture(scope="module")
def corpus():
    dice = random.Random(4)
    vocabulary = [f"v{k}" for k in range(400)]
    pairs = [(k, " ".join(dice.choices(vocabulary, k=dice.randint(3, 150)))) for k in range(60)]
    for k in range(20):
        for _ in range(3):
            pairs.append((len(pairs), edited(pairs[k][1], dice, dice.choice([0, 0.005, 0.01, 0.03, 0.1]))))
    pairs += [(len(pairs) + k, pairs[30][1].upper()) for k in range(15)]
    return pairs


def test_near_classes_against_all_pairs(documents, corpus):
    docs = documents(corpus)
    idf = near.inverse_frequencies(docs)
    found = {r["id"]: r["class_id"] for r in near.near_classes(docs).collect()}
    assert found == by_hand(corpus, idf)


@pytest.mark.parametrize("block", [256, 7])
def test_near_classes_within_a_template(documents, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    dice = random.Random(12)
    fresh = lambda n: [f"w{dice.randint(0, 10**7)}" for _ in range(n)]
    template, pairs = fresh(400), []
    for _ in range(60):
        own = template[:40] + fresh(8) + template[40:] + fresh(8)
        pairs += [(len(pairs) + k, " ".join(own + fresh(18) if k else own)) for k in range(2)]
    docs = documents(pairs)
    expected = by_hand(pairs, near.inverse_frequencies(docs))
    assert 20 < len(set(expected.values())) < 100
    assert {r["id"]: r["class_id"] for r in near.near_classes(docs).collect()} == expected


def test_inverse_frequencies_count_documents(documents):
    pairs = [(1, "a b c d e f"), (2, "a b c d e"), (3, "q"), (4, None)]
    idf = near.inverse_frequencies(documents(pairs))
    common = shingles(words(b"a b c d e"))
    assert idf[near._cells(common)][0] == pytest.approx(1 + np.log(5 / 3))
    assert idf[near._cells(shingles(words(b"q")))][0] == pytest.approx(1 + np.log(5 / 2))


def test_a_cell_counts_once_for_each_document():
    text = " ".join(f"w{k}" for k in range(200_000)).encode()
    (counted,) = near._count_cells(iter([pa.RecordBatch.from_arrays([pa.array([text, b"q"])], names=["text"])]))
    found = dict(zip(counted["cell"].to_pylist(), counted["n"].to_pylist()))
    assert found.pop(-1) == 2 and max(found.values()) <= 2


def test_samples_agree_as_often_as_texts_are_similar():
    dice = random.Random(9)
    idf = np.ones(near.CELLS, np.float32)
    agreed, expected = [], []
    for _ in range(150):
        a = " ".join(dice.choices([f"x{k}" for k in range(60)], k=120))
        b = edited(a, dice, 0.05)
        parts = [near.weighted(t.encode(), idf) for t in (a, b)]
        lengths = np.array([len(p[0]) for p in parts])
        both = near.sample(*[np.concatenate(x) for x in zip(*parts)], np.array([0, lengths[0]]), lengths)
        agreed.append((both[0] == both[1]).mean())
        expected.append(weighted_jaccard(a.encode(), b.encode(), idf))
    assert np.mean(agreed) == pytest.approx(np.mean(expected), abs=0.04)


@pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")
def test_near_dedup_of_the_test_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    idf = near.inverse_frequencies(spark.read.parquet(f"{TESTDATA}/documents.parquet"))
    found = {r["doc_id"]: r["class_id"] for r in contract.queries()["op5_near_dedup"](spark, TESTDATA).collect()}
    assert found == by_hand(rows, idf)


def test_near_dedup_keeps_one_of_each_class(documents, corpus):
    docs = documents(corpus)
    kept = sorted(r["doc_id"] for r in near.near_dedup(docs).collect())
    assert kept == sorted(set(by_hand(corpus, near.inverse_frequencies(docs)).values()))


def test_near_dedup_odd_rows(odd, none):
    found = near.near_classes(odd)
    assert found.count() == odd.count()
    classes = {(r["id"], r["class_id"], r["copies"]) for r in found.collect()}
    assert {(1, 1, 1), (2, 2, 1), (3, 3, 1), (None, 4, 4), (None, None, 1)} <= classes
    left = near.near_dedup(odd)
    assert left.columns == odd.columns and left.where("doc_id = 4").count() == 1
    assert near.near_classes(none).count() == 0 and near.near_dedup(none).count() == 0


def test_compact_windows_hold_every_least_shingle_once():
    dice = random.Random(3)
    for n, least in [(60, 10), (200, 46), (46, 46), (90, 7)]:
        found = np.array([dice.randint(0, 10**6) if n != 90 else dice.randint(0, 5) for _ in range(n)], np.uint64)
        value, low, at, high = compact_windows(found, 1, least)
        full = {k: v for k, v in zip(at.tolist(), value.tolist())}
        spans = {k: (a, b) for k, a, b in zip(at.tolist(), low.tolist(), high.tolist())}
        hashes = near.mixed(found ^ near.mixed(np.array([2], np.uint64)))
        for i in range(n - least + 1):
            for j in {i + least - 1, min(n - 1, i + 2 * least)}:
                c = i + int(np.argmin(hashes[i : j + 1]))
                holding = [k for k, (a, b) in spans.items() if a <= i and j <= b and full[k] == hashes[c]]
                # Of equal shingles in one window the first stands for all.
                assert holding == [c] if n != 90 else len(holding) == 1


def test_passages_are_exact_enough():
    dice = random.Random(8)
    shared = [f"s{k}" for k in range(60)]
    a = [f"a{k}" for k in range(30)] + shared + [f"b{k}" for k in range(30)]
    b = [f"c{k}" for k in range(10)] + shared[:30] + ["changed"] + shared[31:] + [f"d{k}" for k in range(5)]
    one, two = (shingles([w.encode() for w in x]) for x in (a, b))
    everywhere = np.ones(len(one), bool)
    assert passages(one, one, everywhere, 46, 0.8) == [(0, len(one), 0, len(one))]
    assert passages(one, two, everywhere, 46, 0.8) == [(30, 86, 10, 66)]
    assert passages(one, shingles([w.encode() for w in dice.sample(a, len(a))]), everywhere, 46, 0.8) == []


def test_passages_with_edits_are_found_beside_looser_text():
    """Six words replaced in the middle of a hundred; one word changed, next to text that has too many changes."""
    dice = random.Random(2)
    fresh = lambda n: [f"w{dice.randrange(10**7)}" for _ in range(n)]
    digests = lambda w: shingles([x.encode() for x in w])

    def found(a, b):
        return passages(digests(a), digests(b), np.ones(len(a) - 4, bool), 46, 0.8)

    base = fresh(100)
    edited = base[:47] + fresh(6) + base[53:]
    assert found(fresh(20) + base + fresh(30), fresh(5) + edited + fresh(9)) == [(20, 116, 5, 101)]
    one = fresh(90)
    two = [*one[:45], "changed", *one[46:]]
    loose = fresh(60)
    looser = [w if dice.random() < 0.6 else f"y{k}" for k, w in enumerate(loose)]
    for (a, b), (low, high) in (((loose + one, looser + two), (60, 146)), ((one + loose, two + looser), (0, 86))):
        (span,) = found(a, b)
        assert span[0] <= low and high <= span[1] and span[2:] == span[:2]
    assert found(loose, looser) == []


def test_repeated_passages_against_plain_code(documents):
    dice = random.Random(6)
    fresh = lambda n: [f"w{dice.randint(0, 10**7)}" for _ in range(n)]
    planted = [fresh(dice.randint(52, 90)) for _ in range(8)]
    hot = fresh(60)
    pairs, holders = [], {}
    for k in range(80):
        own = planted[k % 8] if k < 32 else hot if k < 70 else fresh(60)
        pairs.append((k, " ".join(fresh(dice.randint(0, 80)) + own + fresh(dice.randint(0, 80)))))
        holders[k] = k % 8 if k < 32 else 8 if k < 70 else None
    pairs += [(100, "short text of few words"), (101, "short text of few words"), (102, None), (103, ""), (104, pairs[79][1])]
    found = {r["doc_id"]: r for r in repeated_passages(documents(pairs)).collect()}
    assert set(found) == {k for k, h in holders.items() if h is not None} | {79, 104}
    for k, r in found.items():
        if k in holders and holders[k] is not None:
            assert r["class_id"] == min(i for i, h in holders.items() if h == holders[k])
            own, text = planted[holders[k]] if holders[k] < 8 else hot, pairs[k][1].split()
            (span,) = r["spans"]
            at = next(i for i in range(len(text)) if text[i : i + len(own)] == own)
            assert span["start"] == at and span["end"] == at + len(own)
    assert found[104]["class_id"] == 79 and found[104]["spans"][0]["end"] == len(re.findall(r"\w+", pairs[79][1]))


def test_copies_that_share_a_passage_with_others_are_passages_from_end_to_end(documents):
    words_of = lambda c, n: [f"{c}{k}" for k in range(n)]
    copied = " ".join(words_of("a", 100) + words_of("licence", 60) + words_of("b", 40))
    other = " ".join(words_of("c", 30) + words_of("licence", 60))
    found = {r["doc_id"]: r for r in repeated_passages(documents([(1, copied), (2, copied), (3, other)])).collect()}
    spans = {k: [(s["start"], s["end"]) for s in r["spans"]] for k, r in found.items()}
    assert spans == {1: [(0, 200)], 2: [(0, 200)], 3: [(30, 90)]}


def test_repeated_passages_odd_rows(odd, none):
    found = repeated_passages(odd)
    assert {r["doc_id"] for r in found.collect()} == {None, 4, 5, 10}
    assert repeated_passages(none).count() == 0


def test_passages_whose_middle_stands_in_many_texts_tie_their_texts(documents):
    """Pairs share 60 words whose middle 40 stand in 30 other texts each; and 60 words with one changed, in the same surroundings."""
    dice = random.Random(21)
    fresh = lambda n: [f"w{dice.randrange(10**8)}" for _ in range(n)]
    pairs, expected = [], {}
    for k in range(12):
        shared = fresh(60)
        changed = shared if k % 2 else [*shared[:30], f"changed{k}", *shared[31:]]
        texts = [fresh(30) + own + fresh(30) for own in (shared, changed)]
        for own in texts:
            expected[1000 * k + 500 + len(expected) % 2] = 1000 * k + 500
            pairs.append((max(expected), " ".join(own)))
        pairs += [(1000 * k + j + (j > 14) * 900, " ".join(fresh(30) + shared[10:50] + fresh(30))) for j in range(30)]
    found = {r["doc_id"]: r for r in repeated_passages(documents(pairs)).collect()}
    assert {k: r["class_id"] for k, r in found.items()} == expected
    assert all((30, 90) == tuple(r["spans"][0]) and r["n_links"] == 1 for r in found.values())


def test_places_that_only_texts_of_other_places_share_are_compared(documents):
    """A text with a passage of one half of another's, and one with the other half: their common middle ties neither to the wrong one."""
    dice = random.Random(22)
    fresh = lambda n: [f"w{dice.randrange(10**8)}" for _ in range(n)]
    left, middle, right = fresh(12), fresh(45), fresh(12)
    texts = [left + middle + right, left + middle + fresh(20), fresh(20) + middle + right]
    texts += [fresh(20) + middle + fresh(20) for _ in range(12)]
    found = {r["doc_id"]: r for r in repeated_passages(documents([(k, " ".join(t)) for k, t in enumerate(texts)])).collect()}
    assert {k: [tuple(s) for s in r["spans"]] for k, r in found.items()} == {0: [(0, 57), (12, 69)], 1: [(0, 57)], 2: [(20, 77)]}


def test_passages_in_other_order_or_beside_earlier_places():
    dice = random.Random(23)
    fresh = lambda n: [f"w{dice.randrange(10**7)}" for _ in range(n)]
    digests = lambda w: shingles([x.encode() for x in w])

    def found(a, b):
        return passages(digests(a), digests(b), np.ones(len(a) - 4, bool), 46, 0.8)

    one, two = fresh(30), fresh(30)
    assert found(one + two, two + one) == [(0, 56, 0, 56)]
    passage = fresh(50)
    assert found(passage, passage[:10] + fresh(70) + passage) == [(0, 46, 80, 126)]


def test_stretches_of_texts_that_repeat_themselves_are_as_similar_as_their_sets():
    dice = random.Random(31)
    for _ in range(40):
        a, b = (np.array([dice.randrange(12) for _ in range(60)]) for _ in range(2))
        start, ends = dice.randrange(20), np.array(sorted(dice.sample(range(21, 60), 8), reverse=True))
        lowest, highest = np.array(sorted(dice.sample(range(25), 8))), np.array(sorted(dice.sample(range(26, 60), 8), reverse=True))
        sets = [(set(a[start:e].tolist()), set(b[low:high].tolist())) for e, low, high in zip(ends, lowest, highest)]
        expected = [len(x & y) / len(x | y) >= 0.8 for x, y in sets]
        assert substring_dedup._similar(a, b, start, ends, lowest, highest, 0.8).tolist() == expected


def test_all_ends_of_a_stretch_are_told_in_one_pass():
    a, b = np.arange(20_000) % 4000, 4000 + np.arange(20_000) % 4000
    ends = np.arange(20_000, 10_000, -1)
    began = time.process_time()
    assert not substring_dedup._similar(a, b, 0, ends, np.zeros(len(ends), int), ends, 0.8).any()
    assert time.process_time() - began < 0.5


def test_passages_of_many_texts_are_those_of_each():
    """With parts that repeat, move, and change; an empty text has none."""
    dice = random.Random(41)
    found = 0
    for vocabulary in (6, 40, 5000) * 8:
        base = [dice.randrange(vocabulary) for _ in range(dice.randrange(60, 260))]

        def variant(x):
            for _ in range(dice.randrange(8)):
                i, j = dice.randrange(len(x)), dice.randrange(len(x))
                x = dice.choice([x[:i] + [9999] + x[i + 1 :], x[:i] + x[j : j + 70] + x[i:], x[i:] + x[:i]])
            return shingles([str(w).encode() for w in x])

        hub, many = variant(base), [variant(base) for _ in range(5)] + [np.empty(0, np.uint64)]
        own = substring_dedup.passages_of_many(many, hub, 46, 0.8)
        assert own == [passages(a, hub, np.ones(len(a), bool), 46, 0.8) for a in many]
        found += sum(map(len, own))
        for a, spans in zip(many, own):
            for i, j, m, n in spans:
                one, other = set(a[i:j].tolist()), set(hub[m:n].tolist())
                assert j - i >= 46 and len(one & other) >= 0.8 * len(one | other)
    assert found > 100


def test_a_hubs_texts_are_compared_together():
    """Texts that share 30 words with a hub, and so no passage, cost far less together than one by one."""
    fresh = count()
    digests = lambda n: [b"w%d" % next(fresh) for _ in range(n)]
    common = digests(30)
    hub = shingles(digests(100) + common + digests(100))
    many = [shingles(digests(40) + common + digests(40)) for _ in range(1000)]
    where = substring_dedup.places_of(hub)
    began = time.process_time()
    assert not any(substring_dedup.passages_of_many(many, hub, 46, 0.8, where))
    together = time.process_time() - began
    began = time.process_time()
    for own in many:
        assert not passages(own, hub, np.ones(len(own), bool), 46, 0.8, where)
    assert together < 0.5 * (time.process_time() - began)


def test_words_are_cut_at_every_other_ascii_character():
    text = bytes(range(256)) + "İstanbul K Ünder\x00x".encode()
    assert words(text) == re.findall(rb"[a-z0-9\x80-\xff]+", text.lower())


def test_words_of_copied_texts_are_counted_once_for_all(documents):
    """Letters whose lower case is ASCII, and texts of fewer words than a passage, which have no row."""
    text = "İ K " + " ".join(f"W{k}" for k in range(60)) + " \t.x"
    few = " ".join(f"v{k}" for k in range(49))
    rows = repeated_passages(documents([(1, text), (2, text), (3, few), (4, few)])).collect()
    assert {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in rows} == {1: [(0, 63)], 2: [(0, 63)]}
