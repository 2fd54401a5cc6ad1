"""Circulant MinHash classes: against brute force over all pairs."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from jobtide.llm import minhash
from jobtide.llm.minhash import COORDINATES, band_keys, hash_set, minhash_classes, permutations, signature

from .conftest import corpus, prose
from .test_pairs import edited


def brute(rows, percent=85, shingle=5):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({b" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, x in enumerate(sets):
        for b in range(a):
            both = len(x & sets[b])
            if both and 100 * both >= percent * (len(x) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(i, least.get(find(n), i))
    return Counter((i, len(s), least.get(find(n)) if s else i) for n, ((i, _), s) in enumerate(zip(rows, sets)))


def got(df):
    return Counter((r.doc_id, r.n, r.component_id) for r in minhash_classes(df).collect())


def test_signature_is_a_circular_shift():
    first, windows = permutations()
    assert sorted(first[:1000]) == sorted(set(first[:1000].tolist())) and len(first) == minhash.UNIVERSE
    hashes = hash_set(prose(1, 50), 5)
    places = first[(hashes % minhash.UNIVERSE).astype(np.int64)].astype(np.int64)
    second = windows[:, 0]
    want = [int(second[(places + k) % minhash.UNIVERSE].min()) for k in range(COORDINATES)]
    assert signature(hashes).tolist() == want
    long = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    assert (signature(long) == np.minimum(signature(long[:2500]), signature(long[2500:]))).all()
    assert len(band_keys(hashes)) == minhash.BANDS and band_keys(hashes[:0]) == []


def test_signature_estimates_similarity():
    draw = np.random.default_rng(5).integers(0, 1 << 63, 3000).astype(np.uint64)
    for shared in (0.85, 0.5):
        cut = round(2000 * (1 - shared) / (1 + shared))
        one, other = np.sort(draw[:2000]), np.sort(draw[cut:2000 + cut])
        assert abs((signature(one) == signature(other)).mean() - shared) < 0.08


def test_parities_bound_the_difference():
    draw = np.random.default_rng(6).integers(0, 1 << 63, 900).astype(np.uint64)
    for cut in (0, 1, 3, 20, 100, 400):
        one, other = np.sort(draw[:500]), np.sort(draw[cut:500 + cut])
        apart = sum(int(x).bit_count() for x in (minhash.parities(one) ^ minhash.parities(other)).view(np.uint64))
        assert apart <= 2 * cut and (apart >= 1.5 * cut or cut > 50)


def test_classes_match_brute_force(spark, docs):
    assert got(docs) == brute([(i, t) for i, t, *_ in corpus()])
    rows = []
    for n in range(25):
        base = prose(500 + n, 60 + 12 * n)
        rows += [(1000 + 10 * n + c, edited(base, 10 * n + c, c * (n % 3 + 1) // 2)) for c in range(6)]
    rows += [(1, "a b c"), (2, "A  b C"), (3, "a b c d"), (4, "a b c d e"), (None, "a b c"), (None, "x y"), (None, "x y")]
    want = brute(rows)
    assert 20 < sum(i != c for i, _, c in want.elements() if i is not None)
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)) == want


def test_chain_of_texts_that_no_first_one_joins(spark):
    """Each text is like its neighbours alone; classes form over several rounds."""
    words = prose(3, 900).split()
    rows = [(i, " ".join(words[10 * i:10 * i + 300])) for i in range(40)]
    want = brute(rows)
    assert {c for _, _, c in want} == {0}
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string")) == want


@pytest.mark.parametrize("size", [60, 240])
def test_a_group_of_near_copies(spark, size):
    """Copies with 0 to 6 changes: classes as by brute force, and no rows by the square of the group."""
    base, made = prose(8, 150), []
    rows = [(i, edited(base, i, i % 7)) for i in range(size)]
    whole = minhash.verified

    def counted(pairs, sets, percent):
        made.append(pairs.count())
        return whole(pairs, sets, percent)

    minhash.verified = counted
    try:
        assert got(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)
    finally:
        minhash.verified = whole
    assert sum(made) < 30 * size


def test_very_long_and_empty(spark, no_docs):
    long = prose(9, 60000)
    rows = [(1, long), (2, long + " end"), (3, ""), (4, None), (5, " \n"), (6, prose(10, 60000))]
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)
    assert got(no_docs) == Counter()
