from __future__ import annotations

import random
from collections import defaultdict

import pytest

from bazaarlens.llm.ngram_join import ngram_components, prefix_length


def by_hand(pairs, words=4, percent=85):
    """All pairs of sets, by their definition."""
    sets = []
    for _, text in pairs:
        found = (text or "").encode().lower().split()
        sets.append({tuple(found[k : k + words]) for k in range(max(1, len(found) - words + 1))} if found else set())
    root = list(range(len(pairs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            shared = len(a & b)
            if shared and 100 * shared >= percent * (len(a) + len(b) - shared):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            least[find(k)].append(i)
    return sorted(((i, len(sets[k]), min(least[find(k)], default=None) if sets[k] else i) for k, (i, _) in enumerate(pairs)), key=str)


def found(df, **options):
    return sorted(map(tuple, ngram_components(df, **options).select("id", "n_shingles", "component_id").collect()), key=str)


def families(seed, members=60, words=120):
    """Texts around templates, edited by shares that straddle the limit, and chains of small edits."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for share in (0.01, 0.02, 0.04):
        template = [word() for _ in range(words)]
        for _ in range(members):
            texts.append(" ".join(word() if rng.random() < share else w for w in template[: rng.randrange(words - 12, words)]))
    chain = [word() for _ in range(words)]
    for _ in range(20):
        chain = [word() if rng.random() < 0.02 else w for w in chain]
        texts.append(" ".join(chain))
    texts += ["a b", "A  B", "a b c", "one", "ONE\n", " ", *texts[:5]]
    texts += [" ".join(word() for _ in range(rng.randrange(1, 200))) for _ in range(30)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, hubs", [(1, 2), (2, 1)])
def test_components_against_all_pairs(documents, seed, hubs):
    pairs = families(seed)
    assert found(documents(pairs).repartition(3), hubs=hubs) == by_hand(pairs)


def test_other_sizes_and_limits(documents):
    pairs = families(3, members=25, words=60)
    assert found(documents(pairs), words=2, percent=70) == by_hand(pairs, 2, 70)


def test_prefix_is_long_enough():
    for n in range(1, 400):
        for percent in (70, 85, 100):
            # Sets that share less than the rest of the prefix leaves cannot link.
            left = n - prefix_length(n, percent)
            assert 100 * left < percent * n


def test_odd_rows(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(odd) == by_hand(rows)
    assert found(none) == []


def test_rarest_are_those_of_a_whole_sort():
    import numpy as np

    from bazaarlens.llm.ngram_join import _rarest

    random_numbers = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 300):
        for most in (1, 3, 1000):
            found = np.unique(random_numbers.integers(0, 10**6, n).astype(np.uint64))
            counts = random_numbers.integers(0, most, len(found))
            for first in {0, len(found) // 7, len(found)}:
                assert (_rarest(found, counts, first) == found[np.lexsort((found, counts))[:first]]).all()
