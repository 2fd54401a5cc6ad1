"""Source divergence: against brute force in whole numbers."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from jobtide.llm import divergence
from jobtide.llm.divergence import source_divergence

from .conftest import WORDS, corpus

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=50):
    """Rows (lang, source, text) to the result's rows."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    found = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: c for (one, s), c in counts.items() if one == lang}
        whole = sum(groups.values(), Counter())

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q, p = shares(whole), {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, values, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(values, key=lambda v: (-v[0], v[1].encode()))[:most]
                found += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ordered)]
    return Counter(found)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                                 "lang string, source string, text string, term string, n int, rank int").repartition(3)


def texts(seed: int, sources: int, n: int) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        source = draw.randrange(sources)
        words = draw.choices([*WORDS, "É", "é", "ß", "Don't", "x1y", "日本", "A"], weights=[1 + (source * i) % 7 for i in range(len(WORDS) + 7)], k=draw.randint(0, 60))
        rows.append((draw.choice(["aa", "bb", None]), f"s{source}" if source else None, " ".join(words)))
    return [*rows, ("cc", "s1", "rare"), ("cc", "s2", None), ("cc", "", ""), ("aa", "none", "1 2 3"), ("aa", "none", None)]


@pytest.mark.parametrize("least,chunk,block", [(30, 1024, 32), (1, 7, 2), (3, 64, 3)])
def test_matches_brute_force(spark, monkeypatch, least, chunk, block):
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = texts(1, 9, 300)
    got = source_divergence(table(spark, rows), least_docs=least)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, least)


def test_odd_rows(spark, docs, no_docs):
    got = source_divergence(docs, least_docs=2, top=3)
    assert Counter(tuple(r) for r in got.collect()) == brute([(lang, s, t) for _, t, lang, s, _ in corpus()], 2, 3)
    assert source_divergence(no_docs).count() == 0


def test_counts_pass_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_FLUSH", 5)
    rows = texts(2, 3, 60)
    assert Counter(tuple(r) for r in source_divergence(table(spark, rows), least_docs=2).collect()) == brute(rows, 2)
