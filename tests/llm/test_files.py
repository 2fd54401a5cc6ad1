"""WARC archives, token files, top-k, mixing: round trips and brute force."""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from jobtide.llm.mixing import hypergeometric, mix, mixed_sizes, placements, ranked, split_quotas, targets
from jobtide.llm import tokens
from jobtide.llm.tokens import Encoder, checksums, token_index, tokenized, write_tokens
from jobtide.llm.topk import nearest
from jobtide.llm.warc import archived, read_archive, write_archive

from .conftest import corpus

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PAGES = [(5, "http://a/x y\r\n", "<p>one</p>"), (3, None, "<p>one</p>"), (9, "http://b", ""), (8, "http://c", None), (4, "http://d", "é" * 5000),
         (7, "http://e", "<p>one</p>"), (7, "http://e", "<p>one</p>"), (7, "http://f", "two"), (None, "http://g", "two"), (None, None, "three"),
         (2, "http://hé", "four"), (None, None, "three")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id bigint, url string, html string, key string, shard string").repartition(3)


@pytest.mark.parametrize("least,roll,shard", [(0, 1 << 20, 1 << 20), (4, 300, 6000)])
def test_archive_round_trip(pages, least, roll, shard):
    payloads = [(p, (h or "").encode()) for p, _, h in PAGES]
    first, count = {}, Counter(b for _, b in payloads)
    for p, b in payloads:
        first[b] = min(first.get(b, p), p, key=lambda x: (x is None, x or 0))
    want, done = Counter(), set()
    for p, b in payloads:
        shared = count[b] > 1 and len(b) >= least
        revisit = shared and (p != first[b] or b in done)
        if shared and p == first[b]:
            done.add(b)
        want[p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", first[b] if revisit else None] += 1
    got = archived(pages, min_revisit_bytes=least, roll_bytes=roll, shard_bytes=shard)
    assert Counter(tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()) == want


def test_archive_is_the_same_however_rows_lie(pages, tmp_path):
    made = []
    for n, rows in enumerate((pages, pages.repartition(5).orderBy(F.desc("url")))):
        manifest = write_archive(rows, str(tmp_path / str(n)), roll_bytes=500, shard_bytes=3000)
        made.append(sorted(tuple(r) for r in manifest.collect()))
        for name, *_, size, sha in made[-1]:
            content = (tmp_path / str(n) / name).read_bytes()
            assert len(content) == size and hashlib.sha256(content).hexdigest() == sha
            assert gzip.decompress(content).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        assert not [f for f in os.listdir(tmp_path / str(n)) if ".warc.gz." in f]
    assert made[0] == made[1] and len(made[0]) > 2


def test_archive_reads_only_the_manifest_and_checks_digests(spark, pages, tmp_path):
    write_archive(pages, str(tmp_path))
    (tmp_path / "part-999999-00000.warc.gz").write_bytes(b"left over")
    assert read_archive(spark, str(tmp_path)).count() == len(PAGES)
    name = spark.read.parquet(str(tmp_path / "manifest")).first()["file"]
    content = gzip.decompress((tmp_path / name).read_bytes()).replace(b"<p>one", b"<p>oNe")
    (tmp_path / name).write_bytes(gzip.compress(content))
    with pytest.raises(Exception):
        read_archive(spark, str(tmp_path)).collect()


def test_archive_of_nothing(pages):
    assert archived(pages.limit(0)).count() == 0


def test_tokens_round_trip(spark, docs, no_docs, tmp_path):
    tokenizer, want, start = Tokenizer.from_file(TOKENIZER), [], 0
    rows = sorted(((i, t or "") for i, t, *_ in corpus()), key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [(i, tokenizer.encode(t, add_special_tokens=False).ids + [1]) for i, t in rows]
    write_tokens(docs, str(tmp_path / "t"), TOKENIZER)
    got = checksums(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)
    for r, (i, _) in zip(got, ids):
        assert (r.doc_id, r.start) == (i, start)
        start += r.n_tokens
    assert [tuple(r) for r in token_index(spark, str(tmp_path / "t")).orderBy("start").select("doc_id", "start").collect()] == [
        (r.doc_id, r.start) for r in got]
    assert tokenized(no_docs, TOKENIZER).count() == 0


def test_words_encode_as_the_whole_text_does(spark):
    texts = ["it's <|endoftext|>x ́a é  \x1cb\x1dc don't", "İstanbul ΣΑΣ ＡＢＣ  nb sp", "a\x85b 1234 !!! 'S", "😀👍🏽 ​zero"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    part = {r.doc_id: r.ids_crc32 for r in tokenized(df, TOKENIZER).collect()}
    assert part == {r.doc_id: r.ids_crc32 for r in tokenized(df, TOKENIZER, whole=True).collect()}


def test_odd_words_encode_as_the_whole_text_does():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    encode, draw = Encoder(Path(TOKENIZER).read_text()), random.Random(4)
    parts = [*"abZIJHTWYKs1-'<|.,;:!?", "\u0130", "\u0131", "\xdf", "\u03a3", "\u03c2", "\xc9", "e\u0301", "\u0307", "\u030c", "\u0331", "\u0308",
             "\u01c4", "\ufb01", "\u212b", "\u1e9e", "\u3099", "\u304b", "\u0483", "\u05d0", "\u200d", "\u2019", "\U0001f600", "\u0e33", "\u20d7"]
    texts = [i + p for i in ("\u0130", "I\u0307", "J\u030c") for p in ".,;:!?"]
    for _ in range(12000):
        words = ["".join(draw.choices(parts, k=draw.randint(1, 5))) + draw.choice(["", "", ".", "?", "?!"]) for _ in range(2)]
        texts.append(" ".join(words))
    for text in texts:
        assert encode(text, None).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def test_words_of_two_generations_stay(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 5)
    tokenizer, encode = Tokenizer.from_file(TOKENIZER), Encoder(Path(TOKENIZER).read_text() + " ")
    for text in ["a b c d", "a b e f", "g h a", "i j k l m n o p", "a b", "", "c d e. f? g!"] * 3:
        assert encode(text, None).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_new_words_of_letters_skip_all_but_the_model(monkeypatch):
    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.seen = tokenizer, []

        def encode(self, text, **how):
            self.seen.append(text)
            return self.tokenizer.encode(text, **how)

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

    whole, config, draw = Tokenizer.from_file(TOKENIZER), Path(TOKENIZER).read_text() + "  ", random.Random(8)
    counting = Counting(Tokenizer.from_str(config))
    monkeypatch.setattr(tokenizers, "Tokenizer", SimpleNamespace(from_str=lambda _: counting))
    encode = Encoder(config)
    words = ["".join(draw.choices("abcdefgéñüßσλдж", k=draw.randint(1, 12))) + draw.choice(["", "", ",", "?!", "***"]) for _ in range(3000)]
    for text in (" ".join(words), "Don't " + " ".join(words[::-1]) + " 12,5 don't", "N\u00c3O n\u00e3o, \u0130x."):
        assert encode(text, None).tolist() == whole.encode(text, add_special_tokens=False).ids
    assert sorted(counting.seen) == sorted([",", "?!", "***", "don't", "12,5", "\u0130x."])


def test_letters_of_all_scripts_encode_as_the_whole_text_does():
    tokenizer, encode, draw = Tokenizer.from_file(TOKENIZER), Encoder(Path(TOKENIZER).read_text()), random.Random(6)
    letters = [chr(c) for c in range(0x41, 0x1200) if chr(c).isalpha()]
    parts = [*letters, *(chr(c) for c in range(0x300, 0x370)), *"'<|>0-" * 9]
    texts = [c + " x" + c + c + "*?" for c in letters]
    texts += ["".join(draw.choices(parts, k=4)) + draw.choice(["", ").", "!'"]) + " a" for _ in range(4000)]
    for text in texts:
        assert encode(text, None).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def test_other_tokenizers_take_no_short_cut_that_differs():
    vocab = {c: i for i, c in enumerate(["a", "b", "c", "x", ".", "\u2581", "ab", "\u2581a"])}
    added, spaced = (Tokenizer(models.BPE(vocab, [("a", "b"), ("\u2581", "a")])) for _ in range(2))
    added.pre_tokenizer, spaced.pre_tokenizer = pre_tokenizers.BertPreTokenizer(), pre_tokenizers.Metaspace()
    added.add_tokens(["bc"])
    for tokenizer in (added, spaced):
        encode = Encoder(tokenizer.to_str())
        for text in ("abc xabc. ab", "a ab ba", "c. abx bc"):
            assert encode(text, None).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def brute_nearest(rows, every, k):
    usable = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256.0 * float(np.float32(x)))) for x in v]
        usable[i] = min(usable.get(i, q), q)
    out = set()
    for i, q in usable.items():
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in usable.items() if j != i and len(c) == len(q))
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])}
    return out


def test_nearest_matches_brute_force(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice([-1.5, -0.25, 0.0, 0.1, 0.5, 2.0]) for _ in range(4)]) for i in range(120)]
    rows += [(200, None), (None, [0.0] * 4), (201, [float("nan"), 0.0, 0.0, 0.0]), (202, [float("inf"), 0.0, 0.0, 0.0]), (203, [None, 0.0, 0.0, 0.0]),
             (210, [1.0, 2.0]), (211, [3.0, 4.0]), (220, []), (0, rows[0][1]), (10, [9.0] * 4), (-10, rows[0][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, q string").repartition(3)
    for k, block in ((5, 8192), (3, 16), (200, 50)):
        got = {tuple(r) for r in nearest(df, every=10, k=k, block=block, query_block=4).collect()}
        assert got == brute_nearest(rows, 10, k)
    assert nearest(df.limit(0), every=10, k=5).count() == 0


@pytest.mark.parametrize("larger", [1.0, 2.0**10, 2.0**21])
def test_nearest_in_parts_matches_brute_force(spark, larger):
    draw = random.Random(6)
    rows = [(i, [larger * draw.choice([-1.0, -0.25, 0.0, 0.5]) for _ in range(3)]) for i in range(-60, 90)]
    rows += [(i, [larger] * 3) for i in range(100, 180)] + [(i, [larger * draw.random()]) for i in range(180, 230)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)
    for k, held, block, query_block in ((4, 2500, 7, 3), (90, 1 << 20, 30, 5)):
        got = [tuple(r) for r in nearest(df, every=5, k=k, held=held, block=block, query_block=query_block).collect()]
        assert len(got) == len(set(got)) and set(got) == brute_nearest(rows, 5, k)


def test_nearest_sends_no_copies_through_the_driver(spark):
    draw = random.Random(7)
    rows = [(i, [draw.choice([-1.5, 0.1, 0.5, 2.0]) for _ in range(8)]) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    # A block of queries for each of 80 blocks of vectors is 10 MB; the queries' vectors are 0.03 MB.
    spark.conf.set("spark.sql.maxBroadcastTableSize", "4m")
    try:
        got = [tuple(r) for r in nearest(df, every=10, k=3, block=50).collect()]
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert len(got) == len(set(got)) and set(got) == brute_nearest(rows, 10, 3)


def brute_targets(sizes, weights=(1, 2, 3), most=3.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = sum(w for s, w in weight.items() if s not in capped)
        level = (total - sum(most * sizes[s] for s in capped)) / free if free else 0
        over = {s for s in names if s not in capped and weight[s] * level > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= over


def test_targets_reshare_the_excess(spark):
    sizes = {"b": 10, "a": 1000, None: 5, "é": 0, "Z": 300}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in targets(df, (1, 2, 3)).collect()}
    assert got == pytest.approx(brute_targets(sizes))
    assert targets(df.limit(0), (1, 2, 3)).count() == 0


def test_mix_comes_near_its_targets(spark, docs, no_docs):
    draw = random.Random(8)
    rows = [(i, "w " * draw.randint(1, 60), f"s{min(draw.randint(0, 9), 4)}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    how = {"block_words": 500, "shard_words": 1000}
    got = mixed_sizes(df, **how).collect()
    assert sorted(got) == sorted(mixed_sizes(df.repartition(5), **how).collect())
    taken, sizes, aim = Counter(), Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        aim[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    assert aim == pytest.approx(brute_targets(sizes))
    assert all(abs(taken[s] - aim[s]) <= 30 for s in aim)
    copies = Counter(r.doc_id for r in mix(df, **how).collect())
    assert copies == Counter({r.doc_id: r.taken // r.size for r in got if r.taken})
    assert mix(df, **how).columns == df.columns
    assert mixed_sizes(no_docs).count() == mix(no_docs).count() == 0
    odd = mixed_sizes(docs).collect()
    assert Counter(r.doc_id for r in odd) == Counter(i for i, *_ in corpus())
    assert {r.source for r in odd} == {"s1", "s2", "s3", "s4", "", None}
    assert mix(docs).columns == docs.columns


def test_mix_fills_its_target_behind_long_documents(spark):
    """Dominating documents that do not fit are passed over; small ones behind them fill the target."""
    rows = [(0, "w " * 20000, "a")] + [(i, "w " * 10, "a") for i in range(1, 1001)]
    rows += [(2000 + i, "w " * 100, "b") for i in range(100)] + [(3000 + i, "w " * 100, "c") for i in range(300)]
    rows += [(4000, "w " * 7000, "d"), (4001, "w " * 5000, "d")] + [(4002 + i, "w " * 30, "d") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for blocks in (1 << 16, 2000):
        got = mixed_sizes(df, block_words=blocks, shard_words=5000).collect()
        taken, aim, most = Counter(), {}, {"a": 20, "b": 50, "c": 50, "d": 30}
        for r in got:
            taken[r.source] += r.taken
            aim[r.source] = r.target
        # Source a has 10,000 words that fit below its target, and none that would bring it nearer.
        assert {s: round(abs(taken[s] - aim[s])) <= most[s] for s in aim} == dict.fromkeys("abcd", True), (taken, aim)
        assert sorted(got) == sorted(mixed_sizes(df.repartition(3), block_words=blocks, shard_words=5000).collect())


def test_every_instance_has_one_shard(spark):
    df = spark.createDataFrame([(i, "w " * 20, f"s{i % 3}") for i in range(300)], "doc_id bigint, text string, source string")
    units, aims, last, placed = placements(df, block_words=100, shard_words=1500)
    rows = placed.collect()
    assert len({(r["rank"], r.block, r.epoch) for r in rows}) == len(rows)
    shards = Counter(r.shard for r in rows)
    assert set(shards) == set(range(4)) and max(shards.values()) - min(shards.values()) <= 2


def test_quotas_add_up_and_follow_the_law(spark):
    counts = {0: 40, 1: 7, 2: 0, 3: 21, 4: 60}
    df = spark.createDataFrame([(r, n) for r, n in counts.items() if n], "rank bigint, n bigint")
    got = split_quotas(df, 5, 2, 1).collect()
    by = defaultdict(int)
    for r in got:
        by[r["rank"]] += r.n
    assert dict(by) == {r: n for r, n in counts.items() if n}
    assert {sum(r.n for r in got if r.shard == s) for s in range(4)} == {32}
    # Inversion over an even grid of u gives the law itself.
    grid = spark.range(20000).select(F.lit(30).cast("bigint").alias("population"), F.lit(12).cast("bigint").alias("marked"),
                                     F.lit(10).cast("bigint").alias("drawn"), ((F.col("id") + 0.5) / 20000).alias("u"))
    from math import comb
    seen = {r.got: r["count"] / 20000 for r in hypergeometric(grid).groupBy("got").count().collect()}
    for k in range(11):
        assert seen.get(k, 0) == pytest.approx(comb(12, k) * comb(18, 10 - k) / comb(30, 10), abs=2e-4)


def test_ranked_orders_nulls_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("B",)], "source string")
    got = {r.source: r["rank"] for r in ranked(df, F.col("source").asc_nulls_last(), "x").collect()}
    assert got == {"B": 0, "a": 1, "b": 2, None: 3}
