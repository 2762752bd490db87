"""A decision list over text statistics, learned by sequential covering."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.text import SPACE_RUNS, cut, lines, strip
from bazaarlens.session import cut_lineage

REPEAT_WINDOW = 5
#: At most so many labelled rows are learned from, taken by a digest of their id.
TRAINING_ROWS = 8_000
#: Thresholds tried for each statistic.
CUTS = 24
MAX_RULES = 12
MAX_CONDITIONS = 3
#: Share of rejected rows that must be labelled bad among the pruning rows of a rule.
PRECISION = 0.8
LEAST_ROWS = 8

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _placed(runs: Column) -> Column:
    return F.transform(runs, lambda run, at: F.struct(run.alias("run"), at.alias("at")))


def _covered(ordered: Column, size: int) -> Column:
    """Positions in runs of ``size`` whose digest occurs twice; equal digests stand side by side."""
    equal = F.filter(
        ordered,
        lambda x, at: ((at > 0) & F.coalesce(F.get(ordered, at - 1)["run"] == x["run"], F.lit(False)))
        | F.coalesce(F.get(ordered, at + 1)["run"] == x["run"], F.lit(False)),
    )
    starts = F.sort_array(F.transform(equal, lambda x: x["at"]))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    return F.aggregate(
        starts,
        zero,
        lambda done, at: F.struct(
            (done["n"] + at + size - F.greatest(at, done["to"])).alias("n"), (at + size).alias("to")
        ),
        lambda done: done["n"],
    )


def text_stats(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``df`` with counts of each whole text, all long.

    ``n_words`` (between ASCII white space), ``word_chars`` (code points in words),
    ``n_symbols`` (of ``#*$%&|<>``), ``n_dup_lines`` (lines with a word, equal to an earlier
    line), ``n_repeat_words`` (words in five-word windows found twice or more; windows
    are told apart by 64-bit digests, and only texts in which two agree are sorted),
    ``n_lines`` (with a word), ``n_upper`` (capital letters), ``n_marks`` (exclamation and
    question marks), ``n_digits``, ``n_distinct`` (words), ``n_doubled`` (words equal to the
    one before). Null and empty texts have zeros.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    tokens = cut(F.col(text_column), SPACE_RUNS)
    worded = F.filter(lines(F.col(text_column)), lambda line: F.length(strip(line)) > 0)
    size = REPEAT_WINDOW
    several = F.size("__words") >= size
    found = (
        df.withColumns({"__words": tokens, "__worded": worded})
        .withColumn(
            "__runs",
            F.when(
                several,
                F.transform(F.sequence(F.lit(1), F.size("__words") - (size - 1)), lambda at: F.xxhash64(F.slice("__words", at, size))),
            ).otherwise(_empty("bigint")),
        )
        .withColumn("__ordered", F.when(F.size(F.array_distinct("__runs")) < F.size("__runs"), F.sort_array(_placed(F.col("__runs")))))
    )
    counts = {
        "n_words": F.size("__words"),
        "word_chars": F.length(F.array_join("__words", "")),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size("__worded") - F.size(F.array_distinct("__worded")),
        "n_repeat_words": F.when(F.col("__ordered").isNull(), 0).otherwise(_covered(F.col("__ordered"), size)),
        "n_lines": F.size("__worded"),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
        "n_marks": F.regexp_count(text, F.lit(r"[!?]")),
        "n_digits": F.regexp_count(text, F.lit(r"[0-9]")),
        "n_distinct": F.size(F.array_distinct("__words")),
        "n_doubled": F.size(
            F.filter("__words", lambda word, at: (at > 0) & (F.get(F.col("__words"), at - 1) == word))
        ),
    }
    drop = ["__words", "__worded", "__runs", "__ordered"]
    return found.withColumns({name: count.cast("long") for name, count in counts.items()}).drop(*drop)


STATS = [*BASE, "n_lines", "n_upper", "n_marks", "n_digits", "n_distinct", "n_doubled"]


def features() -> dict[str, Column]:
    """Ratios of the counts, each safe for texts without words."""

    def per(top: str, bottom: str) -> Column:
        return F.col(top).cast("double") / F.greatest(F.col(bottom), F.lit(1))

    return {
        "log_words": F.log1p(F.col("n_words").cast("double")),
        "mean_word": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "upper_share": per("n_upper", "word_chars"),
        "marks_per_word": per("n_marks", "n_words"),
        "digit_share": per("n_digits", "word_chars"),
        "distinct_share": per("n_distinct", "n_words"),
        "doubled_share": per("n_doubled", "n_words"),
    }


@dataclass
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class Rule:
    """Rows that meet all conditions are rejected."""

    conditions: list[Condition] = field(default_factory=list)

    def column(self) -> Column:
        met = F.lit(True)
        for condition in self.conditions:
            met = met & condition.column()
        return met

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    """Information gained for the bad rows kept when a condition is added."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -math.inf


def _best(counts: dict, cuts: dict[str, list[float]], p0: float, n0: float) -> Condition | None:
    best, chosen = 0.0, None
    for name, at in cuts.items():
        p = n = 0
        for k, threshold in enumerate(at):
            p += counts.get((name, k, 1), 0)
            n += counts.get((name, k, 0), 0)
            for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                if pp >= LEAST_ROWS and nn < n0 and (gain := _gain(pp, nn, p0, n0)) > best:
                    best, chosen = gain, Condition(name, above, threshold)
    return chosen


def _histogram(rows: DataFrame, names: list[str]) -> tuple[dict, float, float]:
    """Rows by statistic, bin and label, in one pass; with the sums of either label."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"bin_{n}").alias("bin")) for n in names]))
    found = rows.select("bad", pairs.alias("x")).groupBy("x.name", "x.bin", "bad").count().collect()
    counts = {(r["name"], r["bin"], r["bad"]): r["count"] for r in found}
    p = sum(v for (name, _, bad), v in counts.items() if name == names[0] and bad)
    n = sum(v for (name, _, bad), v in counts.items() if name == names[0] and not bad)
    return counts, p, n


def _pruned(rule: Rule, rows: DataFrame) -> tuple[Rule, float, float]:
    """The beginning of ``rule`` that does best on rows it was not grown on."""
    sums = []
    for k in range(1, len(rule.conditions) + 1):
        met = Rule(rule.conditions[:k]).column()
        sums += [F.sum((met & (F.col("bad") == b)).cast("long")).alias(f"{'np'[b]}{k}") for b in (0, 1)]
    found = rows.agg(*sums).first()
    scored = []
    for k in range(1, len(rule.conditions) + 1):
        p, n = found[f"p{k}"] or 0, found[f"n{k}"] or 0
        scored.append(((p - n) / (p + n) if p + n else -1.0, -k, p, n))
    _, k, p, n = max(scored)
    return Rule(rule.conditions[:-k]), p, n


def learn_rules(
    labelled: DataFrame,
    label_column: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    training_rows: int = TRAINING_ROWS,
    precision: float = PRECISION,
) -> list[Rule]:
    """Rules that find the rows labelled 0, in order.

    Sequential covering: a rule is grown condition by condition on two thirds of the
    rows by information gain, cut back on the last third, and kept if ``precision`` of what
    it rejects there is labelled 0; the rows it covers are then set aside. Every step
    is one sum over the training table by statistic and bin. That table has at most
    ``training_rows`` rows, the first by a digest of the id; rows without a label are left
    out. Without rows of either label there are no rules.
    """
    picked = labelled.where(F.col(label_column).isin(0, 1)).orderBy(F.xxhash64(F.col(id_column).cast("string")), text_column).limit(training_rows)
    names = list(features())
    rows = text_stats(picked.select(F.col(id_column).alias("id"), F.col(text_column).alias("body"), (1 - F.col(label_column)).cast("int").alias("bad")), "body")
    third = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("part")), F.lit(3))
    rows = cut_lineage(rows.select("bad", third.alias("part"), *[c.alias(n) for n, c in features().items()]))
    shares = [(k + 1) / (CUTS + 1) for k in range(CUTS)]
    # Even quantiles of all rows and of the bad rows: the bad ones are few, and thresholds among them count.
    at = [F.percentile_approx(n, shares, 10_000).alias(n) for n in names]
    bad_at = [F.percentile_approx(F.when(F.col("bad") == 1, F.col(n)), shares, 10_000).alias(f"bad_{n}") for n in names]
    found = rows.agg(F.sum("bad").alias("n_bad"), F.count(F.lit(1)).alias("n"), *at, *bad_at).first()
    if not found["n_bad"] or found["n_bad"] == found["n"]:
        return []
    cuts = {n: sorted({float(x) for x in [*found[n], *found[f"bad_{n}"]]}) for n in names}
    bins = [
        sum(((F.col(n) > t).cast("int") for t in cuts[n]), F.lit(0)).alias(f"bin_{n}") for n in names
    ]
    rest = cut_lineage(rows.select("*", *bins))
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        growing, rule = rest.where(F.col("part") < 2), Rule()
        counts, p, n = _histogram(growing, names)
        while p >= LEAST_ROWS and n and len(rule.conditions) < MAX_CONDITIONS:
            chosen = _best(counts, cuts, p, n)
            if chosen is None:
                break
            rule.conditions.append(chosen)
            growing = growing.where(chosen.column())
            counts, p, n = _histogram(growing, names)
        if not rule.conditions:
            break
        rule, p, n = _pruned(rule, rest.where(F.col("part") == 2))
        if p < 2 or p < precision * (p + n):
            break
        rules.append(rule)
        rest = rest.where(~rule.column())
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects a row, from 1; null if none does."""
    first = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        first = F.when(rule.column(), F.lit(k)).otherwise(first)
    return first


def quality_rules(docs: DataFrame, rules: list[Rule], text_column: str = "text") -> DataFrame:
    """``docs`` with the five base counts, ``base_failed``, ``rejected_by`` and ``kept``.

    ``base_failed``: fewer than 10 words, or more than a fifth of them in repeated five-word
    windows. ``rejected_by`` is the number of the first learned rule that a text meets.
    ``kept`` is false for either. The work is one projection of the table: no shuffle.

    Null and empty texts have no words and fail the base rules. Rows with equal texts
    get equal results. Columns named as the added ones are replaced.
    """
    added = [*BASE, "base_failed", "rejected_by", "kept"]
    # The caller's columns travel in one struct, so none can be taken for a statistic.
    rated = text_stats(docs.select(F.struct("*").alias("own"), F.col(text_column).alias("body")), "body").withColumns(features())
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        rated.withColumns({"base_failed": failed, "rejected_by": verdict(rules)})
        .withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
        .select(*[F.col("own")[c].alias(c) for c in docs.columns if c not in added], *added)
    )
