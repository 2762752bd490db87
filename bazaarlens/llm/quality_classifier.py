"""Text quality by a kernel ridge score over document statistics, calibrated."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.shingles import in_pieces, in_tasks, shingles, words
from bazaarlens.session import cut_lineage

#: At most so many labelled rows are learned from.
TRAINING_ROWS = 16_000
#: Random features, width of the kernel (in standard deviations), ridge penalty.
FEATURES, WIDTH, RIDGE = 256, 2.5, 1e-3
#: Bins of scores that the calibration is fitted on.
BINS = 400
SEED = 31

NAMES = [
    "log_words", "mean_word", "symbols_per_word", "upper_share", "marks_per_word", "digit_share", "other_share",
    "distinct_share", "doubled_share", "distinct_shingles", "dup_line_share", "log_lines",
]


def _classes() -> np.ndarray:
    """Kind of every byte: 0 others, 1 capitals, 2 symbols, 3 marks, 4 digits, 5 beyond ASCII, 6 white space."""
    kinds = np.zeros(256, np.uint8)
    kinds[ord("A") : ord("Z") + 1] = 1
    kinds[[ord(c) for c in "#*$%&|<>"]] = 2
    kinds[[ord(c) for c in "!?"]] = 3
    kinds[ord("0") : ord("9") + 1] = 4
    kinds[128:] = 5
    kinds[[9, 10, 11, 12, 13, 32]] = 6
    return kinds


_KINDS = _classes()


def statistics(text: bytes | None) -> list[float]:
    """The statistics of ``NAMES`` of a whole text; all safe for texts without words."""
    text = text or b""
    kinds = np.bincount(_KINDS[np.frombuffer(text, np.uint8)], minlength=7)
    tokens, rows = text.split(), text.split(b"\n")
    found = shingles(words(text))
    n, size = max(1, len(tokens)), max(1, len(text) - int(kinds[6]))
    doubled = sum(map(bytes.__eq__, tokens, tokens[1:]))
    return [
        np.log1p(len(tokens)), size / n, kinds[2] / n, kinds[1] / size, kinds[3] / n, kinds[4] / size, kinds[5] / size,
        len(set(tokens)) / n, doubled / n, len(np.unique(found)) / max(1, len(found)),
        1 - len(set(rows)) / len(rows), np.log1p(len(rows)),
    ]


def _statistics(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([statistics(text) for text in batch.column("text").to_pylist()], float).reshape(-1, len(NAMES))


@dataclass
class Model:
    """Means and deviations of the statistics, ridge weights, and the calibration's steps."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray | None = None
    scores: np.ndarray | None = None
    chances: np.ndarray | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Cosines of random projections: their products approximate a Gaussian kernel."""
        random = np.random.Generator(np.random.PCG64(SEED))
        turns = random.normal(0, 1 / WIDTH, (len(NAMES), FEATURES))
        shift = random.uniform(0, 2 * np.pi, FEATURES)
        even = np.clip((stats - self.mean) / self.deviation, -6, 6)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(even @ turns + shift), np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def chance(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.scores, self.chances), 0, 1)


def _normal(model: Model):
    """Sums of the normal equations over a partition, upper triangle; column ``FEATURES + 1`` is the right side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FEATURES + 2, FEATURES + 2))
        for batch in batches:
            stats = np.array(batch.column("stats").to_pylist(), float).reshape(-1, len(NAMES))
            z = np.hstack([model.features(stats), batch.column("label").to_numpy()[:, None]])
            sums += z.T @ z
        i, j = np.triu_indices(FEATURES + 2)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(sums[i, j])], names=["i", "j", "v"])

    return run


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_pieces(batches):
        stats = _statistics(batch)
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), batch.column("part"), pa.array(list(stats), pa.list_(pa.float64()))],
            names=["label", "part", "stats"],
        )


def _scored(model: Model, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            if column == "chance":
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.chance(_statistics(batch)))], names=["id", "score"])
            else:
                stats = np.array(batch.column("stats").to_pylist(), float).reshape(-1, len(NAMES))
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(model.raw(stats))], names=["label", "raw"])

    return run


def isotonic(scores: np.ndarray, means: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit to ``means`` in the order of ``scores``: neighbours that fall are pooled."""
    pools: list[list[float]] = []
    for score, mean, weight in zip(scores, means, weights):
        pools.append([score, score, mean, weight])
        while len(pools) > 1 and pools[-2][2] >= pools[-1][2]:
            low, high = pools[-2], pools[-1]
            total = low[3] + high[3]
            pools[-2:] = [[low[0], high[1], (low[2] * low[3] + high[2] * high[3]) / total, total]]
    xs = [x for pool in pools for x in pool[:2]]
    return np.array(xs), np.repeat([pool[2] for pool in pools], 2)


def train(labelled: DataFrame, label_column: str = "quality", id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Fits the score on three quarters of the rows and its calibration on the rest.

    ``labelled`` is bounded by its caller (``TRAINING_ROWS``). Each task sums its part of
    the normal equations, whose size depends on the number of features; the sums are
    added by position. Calibration sees the labels by bin of the score. Without labels
    of either kind every text gets the share of label 1 (0.5 if there are none).
    """
    part = F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit("part")), F.lit(4))
    source = labelled.select(
        F.col(label_column).cast("double").alias("label"), part.alias("part"), F.col(text_column).cast("binary").alias("text")
    ).where(F.col("label").isin(0.0, 1.0))
    rows = cut_lineage(in_tasks(source, _measured, "label double, part bigint, stats array<double>"))
    moments = [f(F.get("stats", F.lit(k))) for k in range(len(NAMES)) for f in (F.avg, F.stddev_pop)]
    found = rows.agg(F.count(F.lit(1)), F.avg("label"), *moments).first()
    share = 0.5 if found[1] is None else found[1]
    if share in (0, 1) or not found[0]:
        model = Model(np.zeros(len(NAMES)), np.ones(len(NAMES)), np.zeros(FEATURES + 1), np.array([0.0]), np.array([share]))
        return model
    moment = np.array(found[2:], float).reshape(-1, 2)
    model = Model(moment[:, 0], np.maximum(moment[:, 1], 1e-6))
    sums = in_tasks(rows.where("part < 3").select("label", "stats"), _normal(model), "i bigint, j bigint, v double")
    entries = sums.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    if not entries.num_rows:
        return Model(model.mean, model.deviation, np.zeros(FEATURES + 1), np.array([0.0]), np.array([share]))
    full = np.zeros((FEATURES + 2, FEATURES + 2))
    full[entries["i"].to_numpy(), entries["j"].to_numpy()] = entries["v"].to_numpy()
    full = full + np.triu(full, 1).T
    left, right, n = full[:-1, :-1], full[:-1, -1], full[-2, -2]
    model.weights = np.linalg.solve(left + RIDGE * max(n, 1) * np.eye(FEATURES + 1) / FEATURES, right)
    held = in_tasks(rows.where("part = 3").select("label", "stats"), _scored(model, "raw"), "label double, raw double")
    bins = held.groupBy(F.floor(F.col("raw") * BINS).alias("bin")).agg(F.avg("raw"), F.avg("label"), F.count(F.lit(1))).orderBy("bin").collect()
    if not bins:
        return Model(model.mean, model.deviation, model.weights, np.array([0.0]), np.array([share]))
    model.scores, model.chances = isotonic(*np.array([b[1:] for b in bins], float).T)
    return model


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each of ``docs``: id and ``score``, the chance of label 1. One pass, no shuffle.

    Null and empty texts are scored as texts without words. Rows with equal texts get equal scores.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    return in_tasks(texts, _scored(model, "chance"), f"id {kind}, score double").withColumnRenamed("id", id_column)
