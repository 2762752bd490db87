"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.shingles import in_pieces, in_tasks
from bazaarlens.session import cut_lineage

#: At most so many labelled rows, chains and lexicon entries are learned from and with.
TRAINING_ROWS = 16_000
TRAINING_CHAINS = 4_000
LEXICON = 20_000
#: Tokens in a chain of the training set, and the share of chains without evidence in it (one in so many).
CHAIN, SPARSE = 32, 16
#: Steps of evidence, each of half a unit from 1 on; a token of a toxic document with this step or more is labelled toxic.
LEVELS, TOXIC_LEVEL = 12, 2
#: Lengths of word beginnings.
BEGINNINGS = range(3, 9)
#: Least number of toxic documents with a word or affix.
LEAST_DOCUMENTS = 4
STEPS, RATE, PENALTY = 80, 0.2, 1e-3

_WORD = re.compile(r"[^\W\d_]+")
_REMEMBERED = 400_000


def forms(word: str) -> list[str]:
    """A word, and its beginnings of three letters and more; languages that build words share those."""
    return [word] + [f"{word[:k]}-" for k in BEGINNINGS if len(word) > k]


def _count_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_pieces(batches):
        sums: dict[str, list[int]] = {}
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            for form in {f for w in set(_WORD.findall((text or "").lower())) for f in forms(w)}:
                sums.setdefault(form, [0, 0])[label] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), *(pa.array([s[k] for s in sums.values()], pa.int64()) for k in (0, 1))],
            names=["form", "clean", "toxic"],
        )


def learn_lexicon(labelled: DataFrame, n_clean: int, n_toxic: int) -> dict[str, float]:
    """Evidence of words and beginnings: a lower bound of the logarithm of how much likelier toxic documents have them.

    Counts are documents of the training rows, summed over tasks. At most ``LEXICON`` entries, the strongest.
    """
    counts = in_tasks(labelled, _count_forms, "form string, clean bigint, toxic bigint")
    rate = (F.col("toxic") + 0.5) / F.lit(n_toxic + 1.0) * F.lit(n_clean + 1.0) / (F.col("clean") + 0.5)
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    scored = (
        counts.groupBy("form").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= LEAST_DOCUMENTS)
        .select("form", (F.log(rate) - 1.96 * spread).alias("evidence"))
        .where("evidence >= 1")
    )
    return {r["form"]: r["evidence"] for r in scored.orderBy(F.desc("evidence"), "form").limit(LEXICON).collect()}


class _Levels(dict):
    """Step of evidence of a word: the strongest of its forms, rounded down."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        evidence = max(self.lexicon.get(form, 0.0) for form in forms(word))
        level = min(LEVELS - 1, max(0, int(2 * evidence) - 1))
        if len(word) <= 64:
            self[word] = level
        return level


@dataclass
class Model:
    """``emission`` by step of evidence, ``turn`` from and to (clean, toxic), and the document's logistic score."""

    lexicon: dict[str, float] = field(default_factory=dict)
    emission: np.ndarray = field(default_factory=lambda: np.zeros(LEVELS))
    turn: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: Of the bias and of each of ``document_features``.
    document: np.ndarray = field(default_factory=lambda: np.array([-2.0, 0.0, 0.0, 0.0]))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def chain_marginals(levels: np.ndarray, at: np.ndarray, n: int, model: Model) -> np.ndarray:
    """Chance of each token ``at`` to be toxic, in a chain of ``n`` tokens whose others have no evidence.

    Forward and backward messages over the tokens with evidence. The stretch between two of them is a
    power of one matrix, taken from its eigenvalues, so the result is that of all ``n`` steps.
    """
    turn, lift = np.exp(model.turn), np.exp(model.emission)
    idle = turn * np.array([1.0, lift[0]])
    values, right = np.linalg.eig(idle)
    left = np.linalg.inv(right)
    scale = values / np.abs(values).max()

    def over(k: int) -> np.ndarray:
        return np.real((right * scale**k) @ left)

    forward, m = np.empty((len(at), 2)), np.array([1.0, lift[0]])
    state, place = (m, 0) if len(at) and at[0] > 0 else (None, 0)
    for k, (t, level) in enumerate(zip(at, levels)):
        own = np.array([1.0, lift[level]])
        state = own if state is None else ((state @ over(t - place - 1)) @ turn) * own
        state = state / state.sum()
        forward[k], place = state, t
    backward, state = np.empty((len(at), 2)), np.ones(2)
    state = over(n - 1 - at[-1]) @ state if len(at) else state
    for k in range(len(at) - 1, -1, -1):
        backward[k] = state
        if k:
            state = turn @ (np.array([1.0, lift[levels[k]]]) * state)
            state = over(at[k] - at[k - 1] - 1) @ state
            state = state / state.sum()
    both = forward * backward
    return both[:, 1] / both.sum(axis=1)


def document_features(chances: np.ndarray, n: int) -> tuple[float, float, float]:
    """Chance that any token is toxic, and logarithms of the expected toxic tokens, in all and in a hundred."""
    expected = float(chances.sum())
    return float(1 - np.prod(1 - chances)), float(np.log1p(expected)), float(np.log1p(100 * expected / max(1, n)))


def tag(text: str | None, known: _Levels, model: Model) -> tuple[tuple[float, ...], list[tuple[int, int, float]]]:
    """Features of the document, and (start, end, chance) of tokens with evidence."""
    low = (text or "").lower()
    found = _WORD.findall(low)
    levels = np.fromiter(map(known.__getitem__, found), np.int8, len(found))
    at = np.flatnonzero(levels)
    if not len(at):
        return (0.0, 0.0, 0.0), []
    chances = chain_marginals(levels[at], at, len(levels), model)
    wanted = set(at.tolist())
    spans = [m.span() for k, m in enumerate(_WORD.finditer(low)) if k in wanted]
    if len(low) != len(text):  # some letters are two in lower case
        place = [k for k, c in enumerate(text) for _ in c.lower()]
        spans = [(place[s], place[e - 1] + 1) for s, e in spans]
    return document_features(chances, len(levels)), [(s, e, float(c)) for (s, e), c in zip(spans, chances)]


def _chains(lexicon: dict[str, float]):
    """Training chains: steps of evidence, token labels; with a weight that makes up for those left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Levels(lexicon)
        for batch in in_pieces(batches):
            out = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                found = _WORD.findall((text or "").lower())
                levels = np.fromiter(map(known.__getitem__, found), np.uint8, len(found))
                for k, t in enumerate(range(0, len(levels), CHAIN)):
                    own = levels[t : t + CHAIN]
                    if own.any() or k % SPARSE == 0:
                        out.append((own.tobytes(), (own >= TOXIC_LEVEL if label else own < 0).tobytes(), 1.0 if own.any() else float(SPARSE)))
            columns = zip(*out) if out else [[]] * 3
            kinds = (pa.binary(), pa.binary(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["levels", "labels", "weight"])

    return run


def fit_chains(levels: np.ndarray, labels: np.ndarray, inside: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Emissions and turns of greatest weighted conditional likelihood, less a penalty, by gradient steps (Adam).

    One row for each chain, padded where ``inside`` is false. The gradient is observed less expected
    counts; these come from forward and backward messages, all chains at once.
    """
    n, width = levels.shape
    levels, labels = np.where(inside, levels, 0).astype(np.int64), np.where(inside, labels, 0).astype(np.int64)
    w = weight / weight.sum()
    pairs = inside[:, 1:]

    def counts(chance: np.ndarray, joint: np.ndarray) -> np.ndarray:
        own = np.bincount(levels.ravel(), (chance * inside * w[:, None]).ravel(), minlength=LEVELS)
        return np.concatenate([own, (joint * (pairs * w[:, None])[:, :, None, None]).sum(axis=(0, 1)).ravel()])

    observed_joint = np.zeros((n, width - 1, 2, 2))
    np.put_along_axis(observed_joint.reshape(n, width - 1, 4), (2 * labels[:, :-1] + labels[:, 1:])[:, :, None], 1.0, axis=2)
    observed = counts(labels.astype(float), observed_joint)
    theta, first, second = np.zeros(LEVELS + 4), np.zeros(LEVELS + 4), np.zeros(LEVELS + 4)
    last = inside.sum(axis=1) - 1
    for step in range(1, STEPS + 1):
        emission, turn = theta[:LEVELS], np.exp(theta[LEVELS:].reshape(2, 2))
        own = np.stack([np.ones_like(levels, float), np.exp(emission)[levels]], axis=2)
        own /= own.sum(axis=2, keepdims=True)
        forward, backward = np.empty((n, width, 2)), np.ones((n, width, 2))
        forward[:, 0] = own[:, 0]
        for t in range(1, width):
            forward[:, t] = (forward[:, t - 1] @ turn) * own[:, t]
            forward[:, t] /= forward[:, t].sum(axis=1, keepdims=True)
        for t in range(width - 2, -1, -1):
            message = (own[:, t + 1] * backward[:, t + 1]) @ turn.T
            message /= message.sum(axis=1, keepdims=True)
            backward[:, t] = np.where((t < last)[:, None], message, 1.0)
        both = forward * backward
        chance = both[:, :, 1] / both.sum(axis=2)
        joint = forward[:, :-1, :, None] * turn * (own * backward)[:, 1:, None, :]
        joint /= joint.sum(axis=(2, 3), keepdims=True)
        gradient = observed - counts(chance, joint) - PENALTY * theta * w.mean()
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return theta[:LEVELS], theta[LEVELS:].reshape(2, 2)


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    weights = np.zeros(x.shape[1])
    for _ in range(60):
        p = _logistic(x @ weights)
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.1 * np.eye(len(weights))
        weights += np.linalg.solve(curve, x.T @ (y - p) - 0.1 * weights)
    return weights


def _document_features(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Levels(model.lexicon)
        for batch in in_pieces(batches):
            found = [tag(text, known, model)[0] for text in batch.column("text").to_pylist()]
            columns = [pa.array(list(c), pa.float64()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), *columns], names=["label", "f0", "f1", "f2"])

    return run


def train(labelled: DataFrame, label_column: str = "toxic", id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Learns lexicon, chain and document score from labelled documents.

    ``labelled`` is bounded by its caller (``TRAINING_ROWS``). Token labels come from the documents: a token of
    a toxic document with strong evidence is toxic, all others are clean. Equal texts count once. Without rows of
    either label the model has no evidence and gives every text the same low score.
    """
    rows = labelled.where(F.col(label_column).isin(0, 1)).select(F.col(text_column).alias("text"), F.col(label_column).cast("int").alias("label"))
    rows = cut_lineage(rows.where(F.col("text").isNotNull()).groupBy("text").agg(F.max("label").alias("label")))
    sums = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sums) < 2:
        return Model()
    model = Model(learn_lexicon(rows, sums[0], sums[1]))
    chains = cut_lineage(in_tasks(rows, _chains(model.lexicon), "levels binary, labels binary, weight double"))
    found = chains.orderBy(F.xxhash64("levels", "labels", "weight")).limit(TRAINING_CHAINS).toArrow()
    if found.num_rows:
        shape = (found.num_rows, CHAIN)
        levels, labels, inside = np.zeros(shape, np.uint8), np.zeros(shape, np.uint8), np.zeros(shape, bool)
        for k, (own, marks) in enumerate(zip(found["levels"].to_pylist(), found["labels"].to_pylist())):
            levels[k, : len(own)], labels[k, : len(own)] = np.frombuffer(own, np.uint8), np.frombuffer(marks, np.uint8)
            inside[k, : len(own)] = True
        model.emission, model.turn = fit_chains(levels, labels, inside, found["weight"].to_numpy())
    scored = in_tasks(rows, _document_features(model), "label int, f0 double, f1 double, f2 double").toArrow()
    x = np.column_stack([scored[f"f{k}"].to_numpy() for k in range(3)])
    model.document = _fit_logistic(x, scored["label"].to_numpy().astype(float))
    return model


def _tagged(model: Model, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Levels(model.lexicon)
        for batch in in_pieces(batches):
            found = [tag(text, known, model) for text in batch.column("text").to_pylist()]
            x = np.array([[1.0, *features] for features, _ in found])
            spans = [[{"start": s, "end": e, "chance": c} for s, e, c in own if c >= least] for _, own in found]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(_logistic(x @ model.document)), pa.array(spans, kind)], names=["id", "score", "spans"]
            )

    return run


def score(docs: DataFrame, model: Model, least: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each of ``docs``: id, ``score`` (chance of a toxic document) and ``spans`` of tokens.

    ``spans`` have start, end (code points of the lower-cased text, end exclusive) and the chance, of ``least`` or more.
    The whole text is one chain. One pass, no shuffle. Null and empty texts have no tokens and the lowest
    score. Rows with equal texts get equal results.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = f"id {kind}, score double, spans array<struct<start:bigint,end:bigint,chance:double>>"
    return in_tasks(texts, _tagged(model, least), schema).withColumnRenamed("id", id_column)
