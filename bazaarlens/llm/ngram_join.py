"""Exact Jaccard join of word n-gram sets by prefix lists, with skipping in the lists and between answers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.components import components
from bazaarlens.llm.shingles import in_pieces, in_tasks, shingles
from bazaarlens.llm.text import KEY, row_key
from bazaarlens.session import written

#: Words of a shingle, and the percentage of the union that two sets must share.
WORDS, PERCENT = 4, 85
#: Shingles are ordered by how often their cell, of so many, occurs; the order changes the work, not the result.
CELLS = 1 << 18
#: Stretches of positions in the prefix of a set that have blocks of their own in a list.
STRETCHES = 4
#: Row keys of 16 bytes: up to so many are sent to every executor, more are shuffled.
BROADCAST_ROWS = 300_000
#: Sets that meet one hub in a task; hubs of a block in the first rounds of comparing what is left, and their growth.
MEETING, HUBS, GROWTH = 1024, 2, 8


def _set(text: bytes | None, size: int) -> tuple[np.ndarray, int]:
    """Distinct shingles of a text, ascending."""
    return np.unique(shingles((text or b"").lower().split(), size))


def _cells(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _scanned(size: int):
    """A row for each text: key, id, digest of its set (null if empty) and size of the set; at the end counts of cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(CELLS, np.int64), None
        names = [KEY, "id", "whole", "n", "cell"]
        for batch in in_pieces(batches):
            sets = [_set(text, size) for text in batch.column("text").to_pylist()]
            digests = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
            counts += np.bincount(np.concatenate([_cells(s) for s in sets]), minlength=CELLS)
            kind = batch.schema.field("id").type
            columns = [batch.column(KEY), batch.column("id"), pa.array(digests, pa.binary()), pa.array([len(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(batch.num_rows, pa.int64())], names=names)
        filled = np.flatnonzero(counts)
        if kind is not None and len(filled):
            none = len(filled)
            columns = [pa.nulls(none, pa.binary()), pa.nulls(none, kind), pa.nulls(none, pa.binary()), pa.array(counts[filled]), pa.array(filled)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def prefix_length(n, percent: int):
    """Shingles of a set of ``n``, rarest first, among which it shares one with every set it links to."""
    return n - (n * percent + 99) // 100 + 1


def _rarest(found: np.ndarray, counts: np.ndarray, first: int) -> np.ndarray:
    """The ``first`` of the ascending ``found`` by count and then by digest; only what may be among them is sorted."""
    if first < len(found):
        some = np.flatnonzero(counts <= np.partition(counts, first - 1)[first - 1]) if first else np.empty(0, np.int64)
        found, counts = found[some], counts[some]
    return found[np.argsort(counts, kind="stable")[:first]]


def _prefixes(counts: np.ndarray, size: int, percent: int):
    """token, node, size and place of the rarest shingles of each set, and a row with its ``node``, a number of its own, and its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in in_pieces(batches):
            tokens, sizes = [], []
            for text in batch.column("text").to_pylist():
                found = _set(text, size)
                first = prefix_length(len(found), percent) if len(found) else 0
                tokens.append(_rarest(found, counts[_cells(found)], first))
                sizes.append(len(found))
            n = batch.num_rows
            lengths = np.array([len(t) for t in tokens])
            own = np.repeat(np.arange(n), lengths)
            place = np.arange(len(own)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            nodes, sizes = number + np.arange(n), np.array(sizes, np.int32)
            number += n
            names = ["token", "node", "size", "place", KEY]
            columns = [np.concatenate(tokens).view(np.int64), nodes[own], sizes[own], place.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(own), pa.binary())], names=names)
            columns = [pa.nulls(n, pa.int64()), pa.array(nodes), pa.array(sizes), pa.nulls(n, pa.int32()), batch.column(KEY)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _meetings(size: int):
    """(a, b, shared): shingles that each set ``a`` shares with the hub ``b`` that its rows follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.empty(0, np.uint64)
        for batch in in_pieces(batches):
            hubs, sides, nodes = (batch.column(c).to_pylist() for c in ("b", "side", "a"))
            out: tuple[list, list, list] = [], [], []
            for hub, side, node, text in zip(hubs, sides, nodes, batch.column("text").to_pylist()):
                own = _set(text, size)
                if side:
                    for column, value in zip(out, (node, hub, len(np.intersect1d(own, known, assume_unique=True)))):
                        column.append(value)
                else:
                    known = own
            columns = [pa.array(x, pa.int64()) for x in out]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "shared"])

    return run


def gathered(pairs: DataFrame, bodies: DataFrame, most: int = MEETING) -> tuple[DataFrame, DataFrame]:
    """b, side, a and text: for each part of a hub's pairs the hub's text (side 0), then those of its ``a``; and the pairs with their part.

    Parts have about ``most`` pairs, whatever a hub has.
    """
    met = written(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")))
    part = F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / most)).cast("int")
    dealt = written(pairs.join(met, "b").withColumn("part", part).drop("n"))
    text = bodies.select(F.col("node").alias("a"), "text")
    hubs = dealt.select(F.col("b").alias("a"), "b", "part").distinct().withColumn("side", F.lit(0))
    sides = dealt.select("a", "b", "part").withColumn("side", F.lit(1)).unionByName(hubs)
    few = met.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] <= BROADCAST_ROWS
    ready = text.join(F.broadcast(sides) if few else sides, "a").repartition("b", "part").sortWithinPartitions("b", "part", "side")
    return ready.select("b", "side", "a", "text"), dealt


def overlaps(pairs: DataFrame, bodies: DataFrame, meetings: Callable, kind: str = "bigint", most: int = MEETING) -> DataFrame:
    """``pairs`` (a, b, size_a, size_b) with what they exactly have in common, as ``shared``.

    ``meetings`` compares the texts that come after a hub's with it. A hub ``b`` has its pairs dealt out in parts of about ``most``, each of which gets the hub's text once.
    """
    ready, dealt = gathered(pairs, bodies, most)
    node = pairs.schema["a"].dataType.simpleString()
    found = in_tasks(ready, meetings, f"a {node}, b {node}, shared {kind}")
    return found.join(dealt.drop("part"), ["a", "b"])


def links_of(compared: DataFrame, percent: float, *more: str) -> DataFrame:
    linked = 100 * F.col("shared") >= percent * (F.col("size_a") + F.col("size_b") - F.col("shared"))
    return compared.where(linked).select("a", "b", *more)


def _fits(n: Column, place: Column, m: Column, other: Column, percent: float) -> Column:
    """Whether sets of ``n`` and ``m`` whose first common shingle has these places can share enough.

    No more than the rest from there on is common, on either side.
    """
    enough = percent * (n + m)
    return (
        (100 * F.least(n, m) >= percent * F.greatest(n, m))
        & ((100 + percent) * (n - place) >= enough)
        & ((100 + percent) * (m - other) >= enough)
    )


def proposed(lists: DataFrame, hubs: int, percent: float) -> tuple[DataFrame, DataFrame]:
    """Pairs of an entry and a hub of a block that can link, with their token; and the hubs' entries.

    A list is cut into blocks by size and by position in the prefix, which bound the sizes that a block's
    sets can link with. An entry meets whole blocks first and passes over those that these bounds exclude.
    Of each block the ``hubs`` sets that come first by a digest are hubs, the same ones in many lists.
    """
    at = ["token", "size_class", "stretch"]
    blocks = written(_blocks(lists).drop("n"))
    rank = F.row_number().over(Window.partitionBy(*at).orderBy(F.xxhash64("node"), "node"))
    chosen = lists.withColumn("rank", rank).where(F.col("rank") <= hubs)
    chosen = written(chosen.select(*at, F.col("node").alias("hub"), F.col("size").alias("hub_size"), F.col("place").alias("hub_place"), F.col("root").alias("hub_root")))
    near = F.explode(F.array(F.col("size_class") - 1, F.col("size_class"), F.col("size_class") + 1))
    meets = lists.select("token", "node", "size", "place", "least", "most", "root", near.alias("size_class"))
    met = meets.join(blocks, ["token", "size_class"]).where(_may_link()).select(*at, "node", "size", "place", "root").join(chosen, at)
    fits = _fits(F.col("size"), F.col("place"), F.col("hub_size"), F.col("hub_place"), percent)
    pairs = met.where((F.col("root") != F.col("hub_root")) & fits).select("token", "node", "size", "root", "hub", "hub_size", "hub_root")
    return pairs, chosen.select("token", F.col("hub").alias("node"))


def _undecided(pairs: DataFrame, references: DataFrame, percent: float) -> DataFrame:
    """Without pairs that the answers of a common reference rule out.

    ``references`` has for each set the one it was first compared with, and what both share. Sets a and b share at most
    what both have of the reference, the lesser of the two, and what neither has of it.
    """
    of = lambda end: references.select(F.col("node").alias(end), F.col("reference").alias(f"{end}_ref"), F.col("shared").alias(f"{end}_shared"))
    known = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    most = F.least("a_shared", "b_shared") + F.least(F.col("size_a") - F.col("a_shared"), F.col("size_b") - F.col("b_shared"))
    out = (F.col("a_ref") == F.col("b_ref")) & ((100 + percent) * most < percent * (F.col("size_a") + F.col("size_b")))
    return known.where(~F.coalesce(out, F.lit(False))).select(*pairs.columns)


def _mixed(lists: DataFrame) -> DataFrame:
    """Entries of lists that hold sets of different roots."""
    mixed = lists.groupBy("token").agg(F.min("root").alias("first"), F.max("root").alias("last")).where("first <> last").select("token")
    return written(lists.join(written(mixed), "token", "left_semi"))


def _relabelled(lists: DataFrame, links: DataFrame) -> DataFrame:
    """Entries whose root is the least of those that ``links`` (root_a, root_b) tie to it directly.

    Equal roots still mean equal components; roots that differ may lie in one, which costs a comparison at most.
    """
    ends = links.select(F.col("root_a").alias("root"), F.col("root_b").alias("other")).union(links.select("root_b", "root_a"))
    least = written(ends.groupBy("root").agg(F.min("other").alias("other")).where("other < root"))
    return lists.join(least, "root", "left").withColumn("root", F.coalesce("other", "root")).drop("other").select(*lists.columns)


def bounded(entries: DataFrame, percent: float) -> DataFrame:
    """Entries token, node, size and place with the sizes that a set can link with through them, their block, and ``root``."""
    n, place = F.col("size"), F.col("place")
    return entries.select(
        "token", "node", "size", "place",
        F.floor(F.log(n) / float(np.log(100 / percent))).cast("int").alias("size_class"),
        F.least(F.floor(place * STRETCHES / (n * (1 - percent / 100) + 1)), F.lit(STRETCHES - 1)).cast("int").alias("stretch"),
        (n * percent / 100).alias("least"),
        (((100 + percent) * (n - place) - percent * n) / percent).alias("most"),
        F.col("node").alias("root"),
    )


def shared_tokens(entries: DataFrame) -> DataFrame:
    """Tokens whose lists have more than one entry."""
    return entries.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token")


def meeting(lists: DataFrame) -> DataFrame:
    """Entries that meet a block of other sets which they may link with, by the bounds of sizes and positions."""
    at = ["token", "size_class", "stretch"]
    near = F.explode(F.array(F.col("size_class") - 1, F.col("size_class"), F.col("size_class") + 1))
    own = F.col("size_class").alias("own_class")
    meets = lists.select("token", "node", "size", "least", "most", own, F.col("stretch").alias("own_stretch"), near.alias("size_class"))
    alone = (F.col("n") == 1) & (F.col("size_class") == F.col("own_class")) & (F.col("stretch") == F.col("own_stretch"))
    met = meets.join(written(_blocks(lists)), ["token", "size_class"]).where(_may_link() & ~alone)
    kept = met.select("token", "node").distinct()
    return lists.join(kept, ["token", "node"], "left_semi").select(*lists.columns)


def _blocks(lists: DataFrame) -> DataFrame:
    """What bounds the sets of each block of a list."""
    return lists.groupBy("token", "size_class", "stretch").agg(
        F.count(F.lit(1)).alias("n"), F.min("size").alias("smallest"), F.max("size").alias("largest"), F.max("most").alias("reach"), F.min("least").alias("from")
    )


def _may_link() -> Column:
    """Whether some set of a block may link with an entry."""
    return (F.col("least") <= F.col("largest")) & (F.col("most") >= F.col("smallest")) & (F.col("reach") >= F.col("size")) & (F.col("from") <= F.col("size"))


def references_of(compared: DataFrame) -> DataFrame:
    """For each set the one that it has most in common with of those it was compared with; a hub is its own."""
    ends = compared.select(F.col("a").alias("node"), F.col("b").alias("reference"), "shared")
    own = compared.select("b", F.col("b").alias("reference"), F.col("size_b").alias("shared"))
    best = ends.union(own).groupBy("node").agg(F.max(F.struct("shared", "reference")).alias("r"))
    return written(best.select("node", "r.reference", "r.shared"))


def all_links(
    lists: DataFrame,
    links: DataFrame,
    tested: DataFrame,
    references: DataFrame,
    compare: Callable[[DataFrame], DataFrame],
    percent: float,
    hubs: int = HUBS,
    roots: DataFrame | None = None,
) -> DataFrame:
    """(node, root) of the components that ``links`` (a, b) and those still missing make.

    Each round compares the sets of the ``lists`` that hold several components with the next hubs, more of them
    each time; pairs in ``tested`` have been compared before. ``roots`` are the components of ``links``, if known.
    """
    tested = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    roots = written(components(links)) if roots is None else roots
    rooted = lists.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lists, found = _mixed(rooted), False
    while not lists.isEmpty():
        proposals, done = proposed(lists, hubs, percent)
        ordered = F.col("node") < F.col("hub")
        ends = {"size": ("size", "hub_size"), "root": ("root", "hub_root")}
        both = [F.when(ordered, F.col(x if e == "a" else y)).otherwise(F.col(y if e == "a" else x)).alias(f"{n}_{e}") for n, (x, y) in ends.items() for e in "ab"]
        pairs = proposals.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"), *both).distinct()
        pairs = written(_undecided(pairs.join(tested, ["a", "b"], "left_anti"), references, percent))
        lists = lists.join(done, ["token", "node"], "left_anti")
        if not pairs.isEmpty():
            compared = written(compare(pairs))
            new = links_of(compared, percent, "root_a", "root_b")
            links, found = links.union(new.select("a", "b")), True
            tested = tested.union(compared.select("a", "b"))
            lists = _mixed(_relabelled(lists, new))
        else:
            lists = written(lists)
        hubs *= GROWTH
    return components(links) if found else roots


def ngram_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text", hubs: int = HUBS
) -> DataFrame:
    """One row for each of ``docs``: ``id``, ``n_shingles`` and ``component_id``, the least id that links lead to.

    A text's set are its distinct runs of ``words`` words (all words as one, if there are fewer), by 64-bit digests; words lie
    between ASCII white space, A-Z in lower case. Sets link if they share ``percent`` % of their union; exactly those links count.

    Equal sets are one from the start. Each set enters the lists of its rarest shingles, with size and position.
    Lists with one set go. What can link by size and position is found block by block (``proposed``). First every set
    is compared with the one hub that most of its lists propose, its reference. Then, in rounds, lists that still hold
    sets of different components compare all of them with more and more hubs, unless the answers of a common reference decide; a hub's entries
    are done after its round, so no link between components is missed, and sets of one component are not compared with one another.

    Null, empty and blank texts have no shingle and are linked with nothing; their ``component_id`` is their own id. Equal rows have a
    row each. Null ids stay null and are never the least; a component of null ids has a null ``component_id``. An empty
    table gives an empty result; other columns are ignored.
    """
    named = row_key(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), "id", "text")
    rows = named.select(KEY, "id", F.col("text").cast("binary").alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    scanned = written(in_tasks(rows, _scanned(words), f"{KEY} binary, id {kind}, whole binary, n bigint, cell bigint"))
    cells = scanned.where("cell is not null").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    members = scanned.where("cell is null")
    sets = written(members.where("whole is not null").groupBy("whole").agg(F.min(KEY).alias("node"), F.max("n").alias("n")))

    # Texts of one row of each set; the rest are left out by a list of what goes, if that is short.
    gone = members.select(KEY, "whole").join(sets, "whole", "left").where(f"node is null or node <> {KEY}").select(KEY).distinct()
    gone = written(gone)
    few = gone.count() <= BROADCAST_ROWS
    single = rows.join(F.broadcast(gone) if few else gone, KEY, "left_anti").select(KEY, "text")
    made = written(in_tasks(single, _prefixes(counts, words, percent), f"token bigint, node bigint, size int, place int, {KEY} binary"))
    entries = made.where("token is not null").drop(KEY)
    # Rows alike in id and text have one key: the first of them stands for all.
    numbers = made.where("token is null").select("node", KEY)
    first = written(numbers.groupBy(KEY).agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("n")))
    repeated = first.where("n > 1").limit(1).count() > 0
    if repeated:
        entries = entries.join(first.select("node"), "node", "left_semi")
    kept = entries.join(written(shared_tokens(entries)), "token", "left_semi")
    lists = written(bounded(kept.withColumns({c: F.col(c).cast("bigint") for c in ("size", "place")}), percent))
    lists = written(meeting(lists))
    wanted = written(first.select("node", KEY).join(lists.select("node").distinct(), "node", "left_semi"))
    few = wanted.count() <= BROADCAST_ROWS
    bodies = single.join(F.broadcast(wanted) if few else wanted, KEY)
    bodies = bodies.dropDuplicates(["node"]) if repeated else bodies
    bodies = written(bodies.select("node", "text"))

    proposals, _ = proposed(lists, 1, percent)
    counted = proposals.groupBy("node", "hub").agg(F.count(F.lit(1)).alias("times"), F.max("size").alias("size_a"), F.max("hub_size").alias("size_b"))
    best = counted.groupBy(F.col("node").alias("a")).agg(F.max(F.struct("times", F.col("hub").alias("b"), "size_a", "size_b")).alias("best"))
    compared = written(overlaps(best.select("a", "best.b", "best.size_a", "best.size_b"), bodies, _meetings(words)))
    references = references_of(compared)
    links = written(links_of(compared, percent))
    found = all_links(lists, links, compared.select("a", "b"), references, lambda pairs: overlaps(pairs, bodies, _meetings(words)), percent, hubs)
    of_sets = sets.join(first.select(F.col(KEY).alias("set"), F.col("node").alias("number")), F.col("node") == F.col("set")).select("whole", F.col("number").alias("node"))
    roots = written(of_sets.join(found, "node", "left").select("whole", F.coalesce("root", "node").alias("root")))
    placed = written(members.join(roots, "whole", "left").select("id", F.col("n").alias("n_shingles"), "root"))
    least = written(placed.where("root is not null").groupBy("root").agg(F.min("id").alias("least")))
    return placed.join(least, "root", "left").select(
        "id", "n_shingles", F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")
    )

