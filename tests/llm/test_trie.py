from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from bazaarlens.llm.centroids import centroid_sums
from bazaarlens.llm.prefix_trie import conversation_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def by_hand(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(v, key=lambda y: y[0])] for c, v in turns.items()}
    rebuilt = {}
    for c in own:
        h, first = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = (*own.get(first, [])[:h], *own[c][h:])
    # Beginnings by number, so that long ones are not compared again and again.
    child, members, of, up, size = {}, defaultdict(list), {}, {0: None}, {0: (0, 0)}
    for c, path in rebuilt.items():
        node = 0
        members[node].append(c)
        for turn in path:
            below = child.setdefault((node, turn), len(child) + 1)
            up[below], size[below] = node, (size[node][0] + 1, len(turn[1].encode()))
            node = below
            members[node].append(c)
        of[c] = node
    children = defaultdict(int)
    for node, above in up.items():
        children[above] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        at = node
        while at is not None:
            leaves[at] += not children[node]
            saved[at] += (len(members[node]) - 1) * size[node][1]
            at = up[at]
    ends = defaultdict(list)
    for c, node in of.items():
        ends[node].append(c)
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (
            (min(m), size[n][0], None if up[n] is None else min(members[up[n]]), len(m), children[n], leaves[n], saved[n], digest(ends[n]))
            for n, m in members.items()
        ),
        key=str,
    )


def found(df, **options):
    return sorted(map(tuple, conversation_trie(df, **options).collect()), key=str)


def test_sums_of_subtrees():
    random.seed(4)
    for n in (1, 2, 3, 40, 300):
        for reach in (1, 3, n):
            parents = [-1] + [random.randrange(max(0, k - reach), k) for k in range(1, n)]
            parents = [-1 if random.random() < 0.02 else p for p in parents]
            values = [[random.randrange(100) for _ in range(n)], [1] * n]
            want = [list(v) for v in values]
            for k in range(n - 1, 0, -1):
                if parents[k] >= 0:
                    for w in want:
                        w[parents[k]] += w[k]
            assert centroid_sums(parents, values) == want


def test_trie_against_plain_code(spark):
    """Nulls, missing first conversations, negative ids, and two long conversations that part late."""
    random.seed(1)
    rows = [
        (random.choice([None, -7, -5, -4, -1, 0, 1, 3, 5, 6, 10, 11, 12, 13, 14]), random.choice([None, *range(1, 10)]),
         random.choice(["u", None, "a"]), random.choice(["x", None, "é", "yy"]))
        for _ in range(150)
    ]
    rows += [(20, k, "u", "t") for k in range(120)] + [(21, k, "u", "t") for k in range(110)]
    rows += [(c, k, "u", "same") for c in range(100, 140) for k in range(3)]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = by_hand(rows)
    # Components that tasks decompose, and ones that joins do.
    assert found(df) == want
    assert found(df, local=25) == want


def test_odd_tables(spark):
    """Repeated rows are turns of their own; ties come in one order; other columns are ignored."""
    rows = [(1, 1, "u", "x")] * 3 + [(2, None, None, None), (2, 1, "b", "y"), (2, 1, "a", "y"), (None, 1, "u", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.withColumns({c: F.lit("mine") for c in ("key", "item", "path", "depth", "node", "n_convs", "piece", "bytes")})
    assert found(clash) == found(df.orderBy(F.desc("role"), F.desc("text")))
    assert max(r[1] for r in found(df)) >= 1 and len({r[:2] for r in found(df)}) == len(found(df))
    assert found(df.limit(0)) == []
    long = "é" * 300_000
    one = spark.createDataFrame([(10, 1, "u", long), (11, 1, "u", long)], SCHEMA)
    assert max(r[6] for r in found(one)) in (0, 600_000)
