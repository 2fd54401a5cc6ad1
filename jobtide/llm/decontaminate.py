"""Benchmark decontamination with a positional inverted index.

The test texts become phrases of n words. Terms of the phrases are counted over the training texts;
a phrase with a term that never occurs is out. For the others the postings (term, text, positions)
of their rarest terms are stored, and the lists are intersected after shifting each position by the
term's offset in the phrase: the rarest list gives the possible starts, the next lists thin them
out. What is left is compared word by word with the text at that place.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobtide.llm.common import release, row_hash, saved

# Words after lower-casing A-Z: digits, a-z and everything outside ASCII.
TEST_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words before lower-casing.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Stands behind the last word of each text in the index of contamination; no word has a blank.
END = " "
BROADCAST_BYTES = 8 << 20
ROW = ["row_a", "row_b"]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def index_terms(text: Column) -> Column:
    """The terms of a text, in order: full lower case, which joins all words alike in ASCII lower case.

    Unlike translate() it is a fast path of the engine; the final comparison separates again what
    it joins. Both lower-case sigmas count as one, because only their place in a word tells them apart.
    """
    folded = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("ς"), F.lit("σ"))
    return F.regexp_extract_all(folded, F.lit(TEST_WORD), F.lit(0))


def _small(df: DataFrame, column: str) -> DataFrame:
    """Mark a saved table for broadcast if it measures at most BROADCAST_BYTES; else Spark shuffles it."""
    measured = df.agg(F.count("*"), F.sum(F.octet_length(column))).first()
    return F.broadcast(df) if 48 * measured[0] + (measured[1] or 0) <= BROADCAST_BYTES else df


def phrases(tests: DataFrame, item_id: str, text: str, n: int) -> tuple[DataFrame, DataFrame]:
    """(pid, phrase, length, terms) of all different windows of n words, and their (pid, item)."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TEST_WORD), F.lit(0))
    windows = (tests.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), words.alias("w"))
               .where("size(w) > 0")
               .select("item", F.explode(F.expr(
                   f"transform(sequence(0, greatest(size(w) - {n}, 0)), i -> slice(w, i + 1, {n}))")).alias("w"))
               .select("item", F.array_join("w", " ").alias("phrase")))
    windows = saved(windows.distinct(), "windows")
    unique = saved(windows.select("phrase").distinct().select(
        F.monotonically_increasing_id().alias("pid"), "phrase", index_terms(F.col("phrase")).alias("terms"))
        .withColumn("length", F.size("terms")), "phrases")
    return unique, windows.join(unique.select("pid", "phrase"), "phrase").select("pid", "item")


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, n): how often each term of the vocabulary occurs in docs (text); absent ones have no row."""
    terms = docs.select(F.explode(index_terms(F.col("text"))).alias("term"))
    return terms.join(_small(vocabulary, "term"), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def postings(docs: DataFrame, vocabulary: DataFrame | None = None, end: bool = False) -> DataFrame:
    """The index of docs (row_a, row_b, text): (term, row_a, row_b, positions), of all terms or the vocabulary's.

    With ``end`` the vocabulary may have END, whose position in a text is its number of words.
    """
    words = index_terms(F.col("text"))
    words = F.array_append(words, END) if end else words
    terms = docs.select(*ROW, F.posexplode(words).alias("position", "term"))
    if vocabulary is not None:
        terms = terms.join(_small(vocabulary, "term"), "term", "left_semi")
    return terms.groupBy("term", *ROW).agg(F.array_sort(F.collect_set("position")).alias("positions"))


def rarest(unique: DataFrame, counts: DataFrame, lists: int | None) -> DataFrame:
    """(pid, place, term, offset): the rarest terms of each phrase of which all terms occur, rarest first."""
    terms = unique.select("pid", "length", F.posexplode("terms").alias("offset", "term"))
    counted = terms.join(counts, "term")
    by_phrase = Window.partitionBy("pid")
    ranked = (counted.withColumn("found", F.count("*").over(by_phrase)).where("found = length")
              .withColumn("place", F.row_number().over(by_phrase.orderBy("n", "term", "offset"))))
    return (ranked if lists is None else ranked.where(F.col("place") <= lists)).select("pid", "place", "term", "offset")


def intersect(index: DataFrame, terms: DataFrame, lists: int, slop: int = 0) -> DataFrame:
    """(pid, row_a, row_b, start): where the listed terms of a phrase stand at their offsets.

    ``slop`` 0 asks for the exact offsets, more lets each term stand up to that many words off its
    own (a proximity match). Terms past ``lists`` are not asked for.
    """
    place = {i: terms.where(F.col("place") == i).drop("place") for i in range(1, lists + 1)}
    found = (place[1].join(index, "term").select("pid", *ROW, F.explode("positions").alias("p"), "offset")
             .select("pid", *ROW, (F.col("p") - F.col("offset")).alias("start")).where("start >= 0"))
    for i in range(2, lists + 1):
        nxt = place[i].select("pid", "term", "offset")
        asked = found.join(nxt, "pid", "left")
        near = (F.expr("array_contains(positions, start + offset)") if slop == 0 else
                F.expr(f"exists(positions, p -> abs(p - start - offset) <= {slop})"))
        found = (asked.join(index, ["term", *ROW], "left").where(F.col("term").isNull() | near)
                 .select("pid", *ROW, "start"))
    return found


def proximity_matches(docs: DataFrame, tests: DataFrame, slop: int, doc_id: str = "doc_id", item_id: str = "item_id",
                      text: str = "text", n: int = 10) -> DataFrame:
    """(doc_id, item, start): places where all terms of a window of n test words stand within slop words of their offsets.

    Nulls, empty texts and repeated rows are taken as in ``contamination``; terms are compared in full lower case.
    """
    row_a, row_b = row_hash(doc_id, text)
    keyed = docs.select(F.col(doc_id).alias("doc_id"), row_a.alias("row_a"), row_b.alias("row_b"), F.col(text).alias("text"))
    unique, items = phrases(tests, item_id, text, n)
    vocabulary = saved(unique.select(F.explode("terms").alias("term")).distinct(), "vocabulary")
    terms = saved(rarest(unique, term_counts(keyed, vocabulary), None), "terms")
    index = saved(postings(keyed, terms.select("term").distinct()), "postings")
    found = intersect(index, terms, n, slop).join(items, "pid").select(*ROW, "item", "start").distinct()
    return keyed.select("doc_id", *ROW).join(found, ROW).select("doc_id", "item", "start")


def contamination(docs: DataFrame, tests: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
                  text: str = "text", n: int = 10, lists: int = 2) -> DataFrame:
    """One row per document row: (doc_id, row_a, row_b, n_words, hits, n_hit, items).

    hits are the occurrences (start, length, pid) of test windows, n_hit the words inside any of them, items
    the ids of their test items as strings, sorted. A window is n consecutive words of an item, or all words
    of a shorter one. A null or empty text has no words and no windows; a null item id counts as "null";
    items or documents that repeat give what one of them gives. Empty tables give no hits or no rows;
    other columns are not read.
    """
    row_a, row_b = row_hash(doc_id, text)
    keyed = docs.select(F.col(doc_id).alias("doc_id"), row_a.alias("row_a"), row_b.alias("row_b"), F.col(text).alias("text"))
    unique, items = phrases(tests, item_id, text, n)
    vocabulary = saved(unique.select(F.explode("terms").alias("term")).distinct(), "vocabulary")
    counts = saved(term_counts(keyed, vocabulary), "counts")
    terms = saved(rarest(unique, counts, lists), "terms")
    asked = saved(terms.select("term").distinct().unionByName(docs.sparkSession.range(1).select(F.lit(END).alias("term"))), "asked")
    index = saved(postings(keyed, asked, end=True), "postings")
    release(docs.sparkSession)
    # The number of words comes from the index too: cutting every text once more costs as much as the index itself.
    ends = index.where(F.col("term") == END).select(*ROW, F.col("positions")[0].cast("bigint").alias("n_words"))
    placed = (intersect(index.where(F.col("term") != END), terms, lists).distinct()
              .join(unique.select("pid", "phrase", "length"), "pid").select(*ROW, F.struct("start", "length", "phrase", "pid").alias("at")))
    found = placed.unionByName(ends, allowMissingColumns=True).groupBy(ROW).agg(
        F.collect_list("at").alias("found"), F.max("n_words").alias("n_words"))

    raw = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RAW_WORD), F.lit(0))
    lower = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
    checked = (keyed.join(found, ROW)
               # A lambda over an array of one binds the words, so that they are cut once per text.
               .withColumn("words", F.when(F.size("found") > 0, F.array(raw)))
               .withColumn("hits", F.expr(
                   "transform(words, w -> filter(found, f -> "
                   f"translate(array_join(slice(w, f.start + 1, f.length), ' '), {lower}) = f.phrase))[0]"))
               .select("doc_id", *ROW, "n_words",
                       F.expr("coalesce(array_sort(transform(hits, h -> struct(h.start, h.length, h.pid))), array())")
                       .cast("array<struct<start: int, length: int, pid: bigint>>").alias("hits")))
    checked = saved(checked.withColumn("n_hit", F.expr(
        "aggregate(hits, struct(0L AS n, 0 AS end), (a, h) -> struct("
        "a.n + greatest(0, h.start + h.length - greatest(a.end, h.start)) AS n,"
        " greatest(a.end, h.start + h.length) AS end), a -> a.n)")), "checked")
    release(docs.sparkSession)
    listed = (checked.select(*ROW, F.explode("hits.pid").alias("pid")).distinct().join(items, "pid")
              .groupBy(ROW).agg(F.array_sort(F.collect_set("item")).alias("items")))
    return (checked.join(listed, ROW, "left")
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))


def drop_contaminated(docs: DataFrame, tests: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
                      text: str = "text", n: int = 10) -> DataFrame:
    """The documents without any test window; columns stay as they are."""
    row_a, row_b = row_hash(doc_id, text)
    hit = (contamination(docs, tests, doc_id, item_id, text, n).where("n_hit > 0")
           .select(F.col("row_a").alias("_llm_a"), F.col("row_b").alias("_llm_b")))
    return (docs.withColumns({"_llm_a": row_a, "_llm_b": row_b}).join(hit, ["_llm_a", "_llm_b"], "left_anti")
            .drop("_llm_a", "_llm_b"))
