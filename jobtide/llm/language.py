"""Language ID by Bayesian evidence fusion.

The text gives a likelihood: letter trigrams under a model of each language and one of no language at
all. A declared language, an address suffix and the host give the rest: how often each language, as the
texts alone would have it, goes with a declaration or a suffix, and which languages a host has, smoothed
towards its domain, and the domain towards all. These are grouped sums over the whole table; a row's own
part is taken out of its host's and domain's sums again. Posterior = prior of the host x declaration x
suffix x text likelihood, normalised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import row_hash, saved

BUCKETS = 1 << 15
NONE = "und"  # no language: letters without order
_KEEP = np.array([b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256)], np.uint8)


def trigrams(text: str | None) -> np.ndarray:
    """The bucket of each trigram of a text's letters; what is no letter counts as one blank."""
    raw = _KEEP[np.frombuffer(f" {(text or '').lower()} ".encode("utf-8", "surrogatepass"), np.uint8)]
    raw = raw[np.concatenate(([True], (raw[1:] != 32) | (raw[:-1] != 32)))].astype(np.uint32)
    if len(raw) < 3:
        return np.array([], np.uint32)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(17)


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = 600,
        most_chars: int = 40_000) -> tuple[list[str], np.ndarray]:
    """Languages and their trigram log-probabilities, from at most ``per_language`` labelled texts of each.

    Every label with a text that is not null is a language. The sample is that of the smallest hashes of ids, of texts
    of at most ``most_chars`` characters; a language with fewer of these is filled up with its shortest other ones.
    The model grows with the number of languages alone. The last row is that of no language.
    """
    known = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).alias("_id"), F.col(label).alias("_label"), F.col(text).alias("text"))
    # 0 for all texts that are short enough; longer ones come after them, by length.
    over = F.when(F.length("text") > most_chars, F.length("text")).otherwise(0)
    keys = known.select("_id", "_label", over.alias("_over")).withColumn("_hash", F.xxhash64("_id"))
    # A histogram in the same order tells which rows can be among the first, so that no task ranks a whole language.
    keys = keys.withColumn("_bin", F.expr(f"if(_over = 0, shiftright(_hash, 56), 128 + _over div {most_chars + 1})"))
    running = Window.partitionBy("_label").orderBy("_bin")
    last = keys.groupBy("_label", "_bin").agg(F.count("*").alias("_m")).withColumn("_m", F.sum("_m").over(running)).groupBy(
        "_label").agg(F.coalesce(F.min(F.when(F.col("_m") >= per_language, F.col("_bin"))), F.max("_bin")).alias("_last"))
    # A row per language, as many as the model has: most rows go here, before any is dealt by its label.
    keys = keys.join(F.broadcast(last), "_label").where("_bin <= _last")
    order = Window.partitionBy("_label").orderBy("_over", "_hash", "_id")
    keys = keys.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language).select("_id", "_label", "_over")
    picked = saved(keys.distinct(), "keys")
    languages = sorted(r[0] for r in picked.select("_label").distinct().collect())
    if not languages:
        return [NONE], np.full((1, BUCKETS), -np.log(BUCKETS), np.float32)
    known = known.withColumn("_over", over)
    sample = known.join(picked, ["_id", "_label", "_over"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch.column(0), batch.column(1)):
                found = counts.setdefault(language.as_py(), np.zeros(BUCKETS, np.int64))
                found += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
        for language, found in counts.items():
            bucket = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(bucket)), pa.array(bucket.astype(np.int32)),
                                              pa.array(found[bucket])], ["label", "bucket", "n"])

    counted = sample.select("_label", "text").mapInArrow(run, "label string, bucket int, n bigint")
    counted = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    table = np.full((len(languages) + 1, BUCKETS), 0.5)
    rows = counted.toPandas()  # bounded: languages x buckets
    place = {language: i for i, language in enumerate(languages)}
    np.add.at(table, ([place[x] for x in rows["label"]], rows["bucket"].to_numpy()), rows["n"].to_numpy())
    table[-1] = 1.0
    return [*languages, NONE], np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def likelihoods(rows: DataFrame, text: str, model: tuple[list[str], np.ndarray], temper: float = 0.2) -> DataFrame:
    """rows without their text, with ``trigrams`` and ``loglik`` (one per language, trigrams taken as dependent by ``temper``)."""
    names, table = model
    keep = [c for c in rows.columns if c != text]
    shared = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for batch in batches:
            counts, sums = [], []
            for t in batch.column(len(keep)):
                total, codes = np.zeros(len(names)), trigrams(t.as_py())
                for begin in range(0, len(codes), 1 << 20):  # bounds the memory of a long text
                    total += logs[:, codes[begin:begin + (1 << 20)]].sum(axis=1, dtype=np.float64)
                counts.append(len(codes))
                sums.append((total * temper).tolist())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(counts, pa.int64()),
                                              pa.array(sums, pa.list_(pa.float64()))], [*keep, "trigrams", "loglik"])

    return rows.select(*keep, text).mapInArrow(run, f"{schema}, trigrams bigint, loglik array<double>")


def _normalised(logs: str) -> str:
    """SQL: probabilities of log weights."""
    shifted = f"transform({logs}, x -> exp(x - array_max({logs})))"
    return f"transform({shifted}, x -> x / aggregate({shifted}, 0D, (s, y) -> s + y))"


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], key: list[str], text: str, declared: str, suffix: str,
             host: str, domain: str, weight: float = 20.0) -> DataFrame:
    """``key`` columns with (language, score, text_language, trigrams, posterior) for each row.

    ``declared``, ``suffix``, ``host`` and ``domain`` name columns of rows; a null in any of them is no evidence of that
    kind. A row whose text has no letters (null, empty) has the language its other evidence gives, and trigrams 0.
    ``weight`` is how many rows the wider level counts for when a narrower one is smoothed. Repeated rows each get
    their result; an empty table gives an empty one.
    """
    names, _ = model
    n = len(names)
    picked = rows.select(*key, F.col(text).alias("_text"), F.col(declared).alias("_declared"), F.col(suffix).alias("_suffix"),
                         F.col(host).alias("_host"), F.col(domain).alias("_domain"))
    scored = likelihoods(picked, "_text", model).withColumn("alone", F.expr(_normalised("loglik")))
    # A text without letters says nothing and counts for nothing in the sums.
    scored = saved(scored.withColumn("alone", F.expr(
        f"if(trigrams > 0, alone, array_repeat(0D, {n}))")), "likelihoods")
    sums = [F.sum(F.element_at("alone", i + 1)) for i in range(n)]
    array = lambda: F.array(*sums)

    everything = [x or 0.0 for x in scored.agg(*sums).first()]
    total = sum(everything)
    overall = [(x + 1.0) / (total + n) for x in everything]
    prior = "array(" + ", ".join(f"{p!r}D" for p in overall) + ")"

    def table(column: str, name: str) -> DataFrame:
        return scored.where(F.col(column).isNotNull()).groupBy(column).agg(array().alias(name))

    # How a declaration or suffix goes with each language, smoothed towards its share of all rows.
    tables = {}
    for column, name in (("_declared", "said"), ("_suffix", "ends")):
        seen = table(column, "n")
        all_of = scored.where(F.col(column).isNotNull()).agg(*sums, F.count("*")).first()
        share = "aggregate(n, 0D, (s, x) -> s + x) / " + f"{max(1.0, float(sum(x or 0.0 for x in all_of[:-1])))!r}D"
        per = "array(" + ", ".join(f"{(x or 0.0)!r}D" for x in all_of[:-1]) + ")"
        tables[column] = seen.select(column, F.expr(
            f"zip_with(n, {per}, (x, t) -> ln((x + {weight} * ({share}) + 1e-9D) / (t + {weight} + 1e-9D)))").alias(name))
    joined = scored
    for column, found in tables.items():
        joined = joined.join(found, column, "left")
    joined = joined.join(table("_domain", "of_domain"), "_domain", "left").join(table("_host", "of_host"), "_host", "left")
    none = f"array_repeat(0D, {n})"
    less_own = lambda c: f"transform(zip_with(coalesce({c}, {none}), alone, (x, y) -> x - if({c} IS NULL, 0D, y)), x -> greatest(0D, x))"
    smoothed = lambda c, wide: (f"zip_with({c}, {wide}, (x, p) -> (x + {weight}D * p)"  # noqa: E731
                                f" / (aggregate({c}, 0D, (s, z) -> s + z) + {weight}D))")
    joined = joined.withColumns({"_d": F.expr(less_own("of_domain")), "_h": F.expr(less_own("of_host"))})
    joined = joined.withColumn("_wide", F.expr(smoothed("_d", prior)))
    joined = joined.withColumn("_near", F.expr(smoothed("_h", "_wide")))
    logs = (f"zip_with(zip_with(loglik, transform(_near, p -> ln(p + 1e-12D)), (x, y) -> x + y),"
            f" zip_with(coalesce(said, {none}), coalesce(ends, {none}), (x, y) -> x + y), (x, y) -> x + y)")
    out = joined.withColumn("_logs", F.expr(logs)).withColumn("posterior", F.expr(_normalised("_logs")))
    label = "array(" + ", ".join("'" + x.replace("'", "\\'") + "'" for x in names) + ")"
    best = lambda c: F.expr(f"element_at({label}, int(array_position({c}, array_max({c}))))")
    return out.select(*key, best("posterior").alias("language"), F.array_max("posterior").alias("score"),
                      F.when(F.col("trigrams") > 0, best("alone")).alias("text_language"), "trigrams", "posterior")


def page_evidence(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """pages with _body, _said, _end, _site and _zone: visible text, declared language, address suffix, host and domain.

    The suffix is a country code at the end of the host, or else a two-letter first step of the path.
    """
    markup = F.coalesce(html, F.lit(""))
    body = F.regexp_replace(F.regexp_replace(markup, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", " ")
    blank = lambda c: F.when(c != "", c)
    site = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    end = F.regexp_extract(site, r"\.([a-z]{2})$", 1)
    step = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)", 1))
    said = F.lower(F.regexp_extract(markup, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return pages.withColumns({"_body": body, "_said": blank(said), "_end": F.coalesce(blank(end), blank(step)),
                              "_site": blank(site), "_zone": blank(F.regexp_extract(site, r"([^.]+\.[^.]+)$", 1))})


def keep_known(docs: DataFrame, model: tuple[list[str], np.ndarray], declared: str, host: str,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose language is one of the model's, columns as they are: neither without letters nor like none."""
    row_a, row_b = row_hash(doc_id, text)
    keyed = docs.withColumns({"_llm_a": row_a, "_llm_b": row_b})
    evidence = keyed.select("_llm_a", "_llm_b", F.col(text).alias("_body"), F.col(declared).alias("_said"),
                            F.col(host).alias("_site"), F.lit(None).cast("string").alias("_none"))
    found = identify(evidence, model, ["_llm_a", "_llm_b"], "_body", "_said", "_none", "_site", "_none")
    known = found.where((F.col("trigrams") > 0) & (F.col("language") != NONE)).select("_llm_a", "_llm_b").distinct()
    return keyed.join(known, ["_llm_a", "_llm_b"], "left_semi").drop("_llm_a", "_llm_b")
