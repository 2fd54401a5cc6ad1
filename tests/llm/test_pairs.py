"""Repeated spans, SimHash classes, contamination: against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from jobtide.llm.common import components
from jobtide.llm.decontaminate import contamination, drop_contaminated, proximity_matches
from jobtide.llm.repeats import remove_repeats
from jobtide.llm.simhash import drop_near_duplicates, fingerprint_of, links, shingles, simhash_classes

from .conftest import corpus, prose


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("k,m", [(35, 16), (8, 3), (5, 5)])
def test_repeats_match_brute_force(docs, k, m):
    texts = [(i, (t or "").encode().split()) for i, t, *_ in corpus()]
    seen = Counter(tuple(w[i:i + k]) for _, w in texts for i in range(len(w) - k + 1))
    want = Counter()
    for i, w in texts:
        gone = set()
        for at in range(len(w) - k + 1):
            if seen[tuple(w[at:at + k])] > 1:
                gone.update(range(at, at + k))
        want[i, len(w), len(gone), b" ".join(x for n, x in enumerate(w) if n not in gone).decode()] += 1
    assert rows_of(remove_repeats(docs, k=k, m=m), "doc_id", "n_words", "n_removed", "kept") == want


def test_repeats_give_compacted_spans(spark):
    passage = prose(9, 40)
    df = spark.createDataFrame([(1, "a b " + passage + " c"), (2, passage + " d")], "doc_id int, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in remove_repeats(df).collect()}
    assert got == {1: [(2, 42)], 2: [(0, 40)]}


def test_repeats_of_nothing(no_docs):
    assert remove_repeats(no_docs).count() == 0


def brute_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_matches_brute_force(docs):
    rows = [(i, brute_fingerprint(t)) for i, t, *_ in corpus()]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        least[find(n)].append(i)
    want = Counter((i, f"{f:016x}", min((x for x in least[find(n)] if x is not None), default=None))
                   for n, (i, f) in enumerate(rows))
    got = simhash_classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("f"), "component_id")
    assert rows_of(got, "doc_id", "f", "component_id") == want


def test_pigeonring_loses_no_link(spark):
    import random
    draw = random.Random(3)
    base = [draw.getrandbits(64) for _ in range(12)]
    fps = {x for b in base for n in range(6) for x in [b ^ sum(1 << p for p in draw.sample(range(64), n))]}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    for most in (0, 1, 3):
        want = {(max(a, b), min(a, b)) for a in signed for b in signed
                if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= most}
        got = links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), most)
        assert {tuple(r) for r in got.collect()} == want


def test_fingerprint_counts_over_half():
    assert fingerprint_of(None) == fingerprint_of("  ") == 0
    assert fingerprint_of("A b") == fingerprint_of("a  B\n")


def test_near_duplicates_keep_one_row(docs, no_docs):
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect())
    texts = [r.text for r in kept.collect()]
    assert ids.count((True, 3)) == 1 and (True, 4) not in ids
    assert sum(not (t or "").strip() for t in texts) == 1  # all texts without words are one class
    assert drop_near_duplicates(no_docs).count() == 0


def test_components_of_a_chain_a_star_and_a_ring(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200, 202: 200}


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RULE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_table(spark):
    long = prose(5, 120).split()
    rows = [(1, " ".join(long[10:24])), (2, " ".join(long[18:30]).upper()), (3, "ONE, two"), (4, None), (5, ""), (6, "absent entirely"),
            (None, "ärger σίσυφος"), (7, "ärger Σίσυφος"), (1, " ".join(long[10:24])), (8, "Ärger"), (9, "same same same")]
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, item string")


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_contamination_matches_brute_force(spark, docs, lists):
    tests = bench_table(spark)
    windows = defaultdict(set)
    for r in tests.collect():
        w = RULE.findall((r.text or "").translate(LOWER))
        for at in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[at:at + 10])].add("null" if r.item_id is None else str(r.item_id))
    want = Counter()
    for i, t, *_ in corpus():
        w, hit, items = RULE.findall((t or "").translate(LOWER)), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at:at + n]) in windows:
                    hit.update(range(at, at + n))
                    items |= windows[tuple(w[at:at + n])]
        want[i, len(w), len(hit), ",".join(sorted(items))] += 1
    got = contamination(docs, tests, lists=lists).withColumn("joined", F.array_join("items", ","))
    assert rows_of(got, "doc_id", "n_words", "n_hit", "joined") == want


def test_contaminated_go_and_clean_stay(spark, docs, no_docs):
    left = drop_contaminated(docs, bench_table(spark))
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {1, 2, 5, 6, 7, 8, None}
    assert left.count() == 8
    assert drop_contaminated(docs, bench_table(spark).limit(0)).count() == docs.count()
    assert drop_contaminated(no_docs, bench_table(spark)).count() == 0


def test_proximity_allows_words_between(spark):
    df = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "alpha beta gamma"), (3, "gamma y y y y beta alpha")], "doc_id int, text string")
    tests = spark.createDataFrame([(1, "alpha beta gamma")], "item_id int, text string")
    assert {r.doc_id for r in proximity_matches(df, tests, slop=0).collect()} == {2}
    assert {r.doc_id for r in proximity_matches(df, tests, slop=1).collect()} == {1, 2}


def edited(base: str, seed: int, changes: int) -> str:
    draw, words = random.Random(seed), base.split()
    for at in draw.sample(range(len(words)), changes):
        words[at] = f"x{seed}y{at}"
    return " ".join(words)


def test_pipeline_keeps_the_contracts_values(spark):
    base = prose(77, 300)
    df = spark.createDataFrame([(1, base), (2, edited(base, 5, 1)), (3, edited(base, 6, 60)), (4, base)], "doc_id bigint, text string")
    near = (fingerprint_of(base) ^ fingerprint_of(edited(base, 5, 1))).bit_count() <= 3
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()} == ({1, 3} if near else {1, 2, 3})


def test_contamination_cuts_each_text_twice(spark, monkeypatch):
    """Words are counted by the index: no pass over the texts of its own; null, empty and repeated rows have their counts too."""
    from jobtide.llm import decontaminate

    docs = spark.createDataFrame(
        [(1, "One two THREE, four"), (1, "One two THREE, four"), (2, None), (3, ""), (4, "İx ς-K 9 — é"), (5, " ,. "), (None, "two three")],
        "doc_id long, text string")
    tests = spark.createDataFrame([("t", "two three")], "item_id string, text string")
    counted, plain = [], decontaminate.F.regexp_count
    monkeypatch.setattr(decontaminate.F, "regexp_count", lambda *a: counted.append(a) or plain(*a))
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in contamination(docs, tests).collect()), key=str)
    words = lambda t: len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or ""))
    hit = {"One two THREE, four", "two three"}
    assert got == sorted(((r["doc_id"], words(r["text"]), *((2, ["t"]) if r["text"] in hit else (0, []))) for r in docs.collect()), key=str)
    assert not counted
