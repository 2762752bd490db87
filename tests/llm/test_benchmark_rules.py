from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from bazaarlens.llm.decontamination import decontaminate
from bazaarlens.llm.quality_rules import BASE, learn_rules, quality_rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def contaminated(text, items):
    w, hit, ids = WORD.findall(ascii_lower(text)), set(), set()
    for item, body in items:
        v = WORD.findall(ascii_lower(body))
        n = min(10, len(v))
        windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v else set()
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in windows:
                hit |= set(range(k, k + n))
                ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def test_decontamination_against_plain_code(spark, documents):
    dice = random.Random(5)
    vocabulary = ["the", "of", "a", "b", "É", "zwei", "x1", "y"]
    items = [(k, " ".join(dice.choices(vocabulary, k=n))) for k, n in enumerate([12, 10, 3, 1, 0, 25, 9, 14])] + [(70, None), (5, "again the same id")]
    items += [(99, items[0][1])]
    pairs = []
    for k in range(60):
        parts = [" ".join(dice.choices(vocabulary + ["n1", "n2", "n3"], k=dice.randint(0, 30))) for _ in range(3)]
        body = dice.choice(items)[1] or ""
        pairs.append((k, f"{parts[0]}, {body.upper() if k % 3 else body}! {parts[1]}\n{parts[2]}"))
    pairs += [(100, None), (101, ""), (102, "the"), (102, "the")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate(documents(pairs), bench).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["n_items"], r["contaminated"]) for r in found)
    expected = []
    for i, text in pairs:
        n, hit, ids = contaminated(text, items)
        expected.append((i, n, hit, ids, len(ids), hit > 0))
    assert got == sorted(expected)


def test_decontamination_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "word word word"), (None, "same1 same2"), (3, None)], "item_id bigint, text string")
    found = decontaminate(odd, bench)
    assert found.count() == odd.count()
    assert found.where("doc_id = 7").first()["n_hit"] == 3000
    assert found.where("text is null or text = ''").where("contaminated or n_words <> 0").count() == 0
    assert decontaminate(none, bench).count() == 0
    assert decontaminate(odd, bench.limit(0)).where("contaminated").count() == 0


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    inside = {j for k, run in enumerate(runs) if runs.count(run) > 1 for j in range(k, k + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_base_counts_against_plain_code(documents):
    dice = random.Random(2)
    texts = [None, "", " \n ", "a b c d e a b c d e", "a a a a a a", "x#y *|* <b>\n \nx#y *|* <b>\né é", "\x0bq\x0cq\x1cq q"]
    texts += [" ".join(dice.choices("ab", k=dice.randint(1, 60))) + "\n" + " ".join(dice.choices("abcdefgh", k=30)) for _ in range(40)]
    found = quality_rules(documents(list(enumerate(texts))), []).collect()
    assert {r["doc_id"]: tuple(r[c] for c in BASE) for r in found} == {k: base(t) for k, t in enumerate(texts)}
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])


def labelled_texts(spark, n=600):
    dice, rows = random.Random(3), []
    for k in range(n):
        words = ["".join(dice.choices("abcdefghij", k=dice.randint(2, 9))) for _ in range(dice.randint(30, 90))]
        kind = k % 6
        text = " ".join(words) if kind > 1 else " | ".join(words) if kind else "!! ".join(words).upper()
        rows.append((k, text, int(kind > 1)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, quality int")


def test_learned_rules_reject_bad_and_keep_good(spark):
    rows = labelled_texts(spark)
    rules = learn_rules(rows.where("doc_id % 18 >= 6"))
    assert rules and all(1 <= len(rule.conditions) <= 3 and str(rule) for rule in rules)
    found = quality_rules(rows.where("doc_id % 18 < 6"), rules)
    assert found.where("quality = 0 and kept").count() <= 2
    assert found.where("quality = 1 and not kept").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_rules_without_both_labels(spark):
    rows = labelled_texts(spark, 60)
    assert learn_rules(rows.where("quality = 1")) == []
    assert learn_rules(rows.where("quality = 5")) == []
    assert learn_rules(rows.withColumn("quality", F.lit(None).cast("int"))) == []


def test_quality_rules_odd_rows(odd, none):
    found = quality_rules(odd, [])
    assert found.count() == odd.count() and set(odd.columns) <= set(found.columns)
    assert found.where("text is null or trim(text) = ''").where("kept").count() == 0
    assert {r["upper_share"] for r in found.collect()} == {"mine"}
    assert quality_rules(none, []).count() == 0
