"""Near duplicates by consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.components import components
from bazaarlens.llm.ngram_join import all_links, bounded, links_of, meeting, overlaps, references_of, shared_tokens
from bazaarlens.llm.shingles import in_pieces, in_tasks, mixed, shingles, words
from bazaarlens.llm.text import KEY, row_key, without
from bazaarlens.session import written

SIMILARITY = 0.8
BANDS, ROWS = 9, 3
#: Document frequencies are counted in so many hashed cells.
CELLS = 1 << 18
#: Random draws are shared by shingles whose digests fall on the same of so many places.
DRAWS = 1 << 16
#: Row keys of 16 bytes: up to so many are sent to every executor, more are shuffled.
BROADCAST_ROWS = 300_000
#: Texts that meet one hub in a task.
BLOCK = 256
#: Similarities are sums of fractions: what is short of the limit by rounding alone counts.
SLACK = 1e-9


def _cells(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per cell over a partition; cell -1 counts the documents."""
    counts, n = np.zeros(CELLS, np.int64), 0
    for batch in in_pieces(batches):
        found = [np.unique(_cells(shingles(words(text)))) for text in batch.column("text").to_pylist()]
        n += len(found)
        counts += np.bincount(np.concatenate(found), minlength=CELLS)
    filled = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(filled, -1)), pa.array(np.append(counts[filled], n))], names=["cell", "n"]
    )


def inverse_frequencies(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Weight of each cell: ``1 + ln((1 + documents) / (1 + documents with the cell))``.

    Every document counts, once for each of its cells, so weights are 1 or more. What reaches the driver is one number for each of ``CELLS`` cells,
    however large the corpus.
    """
    counted = in_tasks(docs.select(F.col(text_column).cast("binary").alias("text")), _count_cells, "cell bigint, n bigint")
    rows = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells, sums = rows["cell"].to_numpy(), rows["n"].to_numpy()
    n = sums[cells == -1].sum()
    frequency = np.zeros(CELLS)
    frequency[cells[cells >= 0]] = sums[cells >= 0]
    return (1 + np.log((1 + n) / (1 + frequency))).astype(np.float32)


def _draws() -> tuple[np.ndarray, ...]:
    """Gamma(2, 1), the logarithm of another, and a uniform shift, for every place."""
    random = np.random.Generator(np.random.PCG64(20))
    r = random.gamma(2, 1, DRAWS).astype(np.float32)
    return r, np.log(random.gamma(2, 1, DRAWS)).astype(np.float32), random.random(DRAWS).astype(np.float32)


def weighted(text: bytes | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text in order, and their TF-IDF weights."""
    found, times = np.unique(shingles(words(text)), return_counts=True)
    return found, times.astype(np.float32) * idf[_cells(found)]


def sample(found: np.ndarray, weights: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Improved consistent weighted samples: a row for each text, ``BANDS * ROWS`` columns.

    Texts are stretches of ``found`` and ``weights``. Two texts agree in a column with the
    probability of their weighted Jaccard similarity.
    """
    r, log_c, shift = _draws()
    log_weight = np.log(weights)
    own = np.repeat(np.arange(len(starts)), lengths)
    odd = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.empty((len(starts), BANDS * ROWS), np.uint64)
    for k in range(BANDS * ROWS):
        at = ((found * odd[k]) >> np.uint64(48)).astype(np.int64)
        rate, moved = r[at], shift[at]
        level = np.floor(log_weight / rate + moved)
        value = log_c[at] - rate * (level - moved + 1)
        least = np.flatnonzero(value == np.repeat(np.minimum.reduceat(value, starts), lengths))
        first = least[np.concatenate(([True], np.diff(own[least]) != 0))]
        out[:, k] = mixed(found[first] ^ mixed(level[first].astype(np.int64).view(np.uint64)))
    return out


def _banded(samples: np.ndarray) -> np.ndarray:
    parts = samples.reshape(len(samples), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        out = mixed(out * np.uint64(31) + parts[:, :, k])
    return out


def _sketch(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            texts = batch.column("text").to_pylist()
            split = [words(text) for text in texts]
            some = [k for k, w in enumerate(split) if w]
            digests: list[bytes | None] = [None] * len(texts)
            bands, whole = np.zeros((len(texts), BANDS), np.uint64), np.zeros(len(texts))
            if some:
                pairs = []
                for k in some:
                    digests[k] = hashlib.md5(b" ".join(split[k])).digest()
                    found, times = np.unique(shingles(split[k]), return_counts=True)
                    pairs.append((found, times.astype(np.float32) * idf[_cells(found)]))
                    whole[k] = pairs[-1][1].sum(dtype=np.float64)
                lengths = np.array([len(found) for found, _ in pairs])
                starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                flat = [np.concatenate(x) for x in zip(*pairs)]
                bands[some] = _banded(sample(*flat, starts, lengths))
            columns = [batch.column(KEY), batch.column("id"), pa.array(digests, pa.binary())]
            columns.append(pa.array(whole))
            columns += [pa.array(bands[:, k].copy().view(np.int64)) for k in range(BANDS)]
            yield pa.RecordBatch.from_arrays(columns, names=[KEY, "id", "node", "weight", *(f"b{k}" for k in range(BANDS))])

    return run


def _shared(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Weight that two texts have in common."""
    (fa, wa), (fb, wb) = one, two
    _, at, bt = np.intersect1d(fa, fb, assume_unique=True, return_indices=True)
    return float(np.minimum(wa[at], wb[bt]).sum(dtype=np.float64))


def _weighted_prefixes(idf: np.ndarray, least: float):
    """token, node, size (weight of the text) and place (weight before the token) of the rarest shingles of each text.

    Two texts that are similar enough share one of these: of what comes later each holds less than they must have in common.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            nodes, tokens, sizes, places = [], [], [], []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                found, weights = weighted(text, idf)
                order = np.lexsort((found, -idf[_cells(found)]))
                found, weights = found[order], weights[order].astype(np.float64)
                whole = float(weights.sum())
                before = np.cumsum(weights) - weights
                kept = int(np.searchsorted(before, whole * (1 - least), "right"))
                nodes += [node] * kept
                tokens.append(found[:kept])
                sizes.append(np.full(kept, whole))
                places.append(before[:kept])
            flat = [np.concatenate(x) if x else np.empty(0) for x in (tokens, sizes, places)]
            columns = [pa.array(flat[0].astype(np.uint64).view(np.int64)), pa.array(nodes, pa.binary()), pa.array(flat[1]), pa.array(flat[2])]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "node", "size", "place"])

    return run


def _weighted_meetings(idf: np.ndarray):
    """(a, b, shared): weight that each text ``a`` has in common with the hub ``b`` that its rows follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weighted(None, idf)
        for batch in in_pieces(batches):
            out: tuple[list, list, list] = [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("b", "side", "a", "text")))
            for hub, side, node, text in rows:
                own = weighted(text, idf)
                if side:
                    for column, value in zip(out, (node, hub, _shared(own, known))):
                        column.append(value)
                else:
                    known = own
            columns = [pa.array(x, t) for x, t in zip(out, (pa.binary(), pa.binary(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "shared"])

    return run


def _bodies(rows: DataFrame, places: DataFrame) -> DataFrame:
    """node and text of ``places`` (node, row)."""
    few = places.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = rows.select(F.col(KEY).alias("row"), F.col("text").cast("binary").alias("text"))
    return texts.join(F.broadcast(places) if few else places, "row").dropDuplicates(["node"]).select("node", "text")


def _classes(placed: DataFrame, compared: DataFrame, bodies: DataFrame, idf: np.ndarray, percent: float) -> DataFrame:
    """(node, root) of the classes that links of ``compared`` make, and those between texts that meet in a band and are still in different classes.

    The latter enter the lists of their rarest shingles, by weight; texts of a loose family, which share what is
    frequent only, do not meet there. Members of a list are compared with its hubs, in rounds, until
    a list is of one class or all that weight and position allow has been compared. For a comparison a task gets one text,
    and each hub's once for many.
    """
    links = written(links_of(compared, percent))
    joined = written(components(links))
    classed = placed.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = classed.groupBy("band", "place").agg(F.min("root").alias("first"), F.max("root").alias("last")).where("first <> last")
    nodes = written(placed.join(written(mixed.select("band", "place")), ["band", "place"], "left_semi").select("node").distinct())
    open_bodies = bodies.join(nodes, "node", "left_semi")
    entries = written(in_tasks(open_bodies, _weighted_prefixes(idf, percent / 100), "token bigint, node binary, size double, place double"))
    lists = written(meeting(written(bounded(entries.join(written(shared_tokens(entries)), "token", "left_semi"), percent))))
    compare = lambda pairs: overlaps(pairs, bodies, _weighted_meetings(idf), "double", BLOCK)
    return all_links(lists, links, compared.select("a", "b"), references_of(compared), compare, percent, roots=joined)


def near_classes(
    docs: DataFrame, similarity: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row for each of ``docs``: its row key, ``id``, ``class_id`` (least id of its class), ``copies`` and ``kept``.

    Texts are multisets of five-word shingles (all words, if there are fewer), each
    weighted by its count and by how few documents hold its hashed cell. Consistent
    weighted samples are banded; texts that meet in a band are tied to two of the
    band's texts, which differ from band to band. Of these ties the one that most bands
    propose for a text is verified on the whole texts. Then texts that meet in a band and are
    still in different classes are compared wherever they share a shingle among their rarest, as all similar ones do. Links inside a class
    cannot change it. Classes are the connected components; equal word
    sequences form one node from the start, so copies are never paired.

    Texts without words (null and empty ones too) are classes of their own. Of each class the row
    with the least id (of equal ids, the least row key) is ``kept``; null ids come
    last, and a class of null ids has a null ``class_id``. Rows equal in id and text share a row key.
    """
    rows = row_key(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), "id", "text")
    idf = inverse_frequencies(rows)
    kind = rows.schema["id"].dataType.simpleString()
    bands = [f"b{k}" for k in range(BANDS)]
    schema = f"{KEY} binary, id {kind}, node binary, weight double, " + ", ".join(f"{b} bigint" for b in bands)
    sketched = written(in_tasks(rows.select(KEY, "id", F.col("text").cast("binary").alias("text")), _sketch(idf), schema))
    texts = written(
        sketched.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(KEY).alias("row"), F.max("weight").alias("weight"), *[F.first(b).alias(b) for b in bands])
    )
    placed = texts.select("node", "weight", F.explode(F.array(*[F.struct(F.lit(k).alias("band"), F.col(b).alias("place")) for k, b in enumerate(bands)])).alias("x"))
    placed = placed.select("node", "weight", "x.band", "x.place")
    order = F.xxhash64("band", "node")
    # Sums by key are written before a join by that key: then it deals both sides anew and can split a hot one.
    hubs = written(
        placed.groupBy("band", "place")
        .agg(F.min(F.struct(order, "node", "weight")).alias("first"), F.max(F.struct(order, "node", "weight")).alias("last"))
        .where(F.col("first.node") != F.col("last.node"))
        .select("band", "place", F.explode(F.array("first", "last")).alias("hub"))
    )
    # Copies are one text already; of the ties of a text the one that most bands propose is compared first.
    proposals = written(
        placed.join(hubs, ["band", "place"])
        .where(F.col("node") != F.col("hub.node"))
        .groupBy(F.col("node").alias("a"), F.col("hub.node").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("size_a"), F.max("hub.weight").alias("size_b"))
    )
    best = proposals.groupBy("a").agg(F.max(F.struct("n", "b", "size_a", "size_b")).alias("best")).select("a", "best.b", "best.size_a", "best.size_b")
    best = written(best)
    ends = best.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    bodies = written(_bodies(rows, written(texts.select("node", "row").join(ends, "node", "left_semi"))))
    compared = written(overlaps(best, bodies, _weighted_meetings(idf), "double", BLOCK))
    joined = _classes(placed, compared, bodies, idf, 100 * (similarity - SLACK)).withColumnRenamed("root", "class")
    member = written(
        sketched.select(KEY, "id", "node").join(joined, "node", "left").withColumn("class", F.coalesce("class", "node"))
    )
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", KEY))
    chosen = written(
        member.where(F.col("class").isNotNull()).groupBy("class").agg(least.alias("first"), F.count(F.lit(1)).alias("copies"))
    )
    return (
        member.join(chosen, "class", "left")
        .select(
            KEY,
            "id",
            F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
            F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
            (F.col("class").isNull() | (F.col("first")[KEY] == F.col(KEY))).alias("kept"),
        )
    )


def near_dedup(docs: DataFrame, similarity: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each class of near duplicates; see ``near_classes``.

    Rows equal in id and text are one row written twice, of which one stays.
    """
    own = docs.columns
    kept = near_classes(docs, similarity, id_column, text_column).where("kept").select(KEY).distinct()
    left = row_key(without(docs, KEY), id_column, text_column).join(kept, KEY, "left_semi")
    return left.dropDuplicates([KEY]).select(*own)
