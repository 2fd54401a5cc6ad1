"""Tables that grow by batches and tables stored for later joins, on the fixture tables, with their oracles."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from driver_checks import operator_queries as q
from driver_checks import shapes as s
from driver_checks import table_queries as t
from driver_checks import report_queries as r
from jobtide.operators import groups, joins, windows
from jobtide.plans import marts, quality, refresh
from jobtide.sources import readers, writers
from jobtide.sources.catalog import BRONZE, SEED_BRONZE, SEEDS

QUERIES = {}
ORACLE = {}


def query(sql: str):
    """Register a query under its function name, with the SQL that must give the same rows."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        ORACLE[fn.__name__] = sql
        return fn
    return add


def _arriving(spark, d):
    """Postings with their partition, in two batches: the second brings the last two years and late rows of one source."""
    month = F.date_format("posted_at", "yyyy-MM")
    late = (F.col("posted_at") >= "1997-01-01") | (F.col("data_source") == "kaggle_ds") & (F.col("state") == "ASIA")
    return s.postings(spark, d).withColumns({
        "month": month, "batch": F.when(late, "second").otherwise("first")})


def _two_batches(spark, d):
    """The postings table after both batches, and the trend table that follows it."""
    arrived, folder, by = _arriving(spark, d), q.scratch(spark), ["data_source", "month"]
    build = lambda rows: rows.drop("batch")
    months = lambda rows: marts.trend_months(rows.where("month IS NOT NULL")).withColumn(
        "month", F.date_format("report_month", "yyyy-MM"))
    for rows in (arrived.where("batch = 'first'"), arrived):
        touched = refresh.refresh(rows, f"{folder}/postings", by, "batch", build)
        postings = refresh.refreshed(spark, f"{folder}/postings", build(arrived))
        refresh.rebuild(postings, f"{folder}/months", by, touched, months)
    return postings, refresh.refreshed(spark, f"{folder}/months", months(build(arrived)))


@query(t.ORACLE["market_trends"])
def refresh_trends(spark, d):
    return marts.compare_months(_two_batches(spark, d)[1])


@query(t.ORACLE["market_snapshot"])
def refresh_snapshot(spark, d):
    return marts.market_snapshot(_two_batches(spark, d)[0])


@query("""
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def dedup_history(spark, d):
    events, path = s.table(spark, d, "events"), f"{q.scratch(spark)}/latest"
    day = F.dayofmonth("ts")
    for number, rows in enumerate((events.where(day <= 10), events.where(day > 20), events.where((day > 10) & (day <= 20)))):
        refresh.merge_first(rows, path, "user_id", windows.latest_first("ts", "event_id"), buckets=16, number=number)
    return refresh.merged_rows(spark, path).select("user_id", "event_id", "event_type", "value")


@query("""
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders
WHERE o_orderpriority <> '5-LOW' GROUP BY 1
UNION ALL SELECT NULL, o_orderkey FROM orders WHERE o_orderpriority = '5-LOW'""")
def dedup_history_first(spark, d):
    """The first row per key counts and rows without a key all stay; the last batch comes twice."""
    rows = s.table(spark, d, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("o_custkey"), "o_orderkey", "o_orderdate", "o_orderstatus")
    path = f"{q.scratch(spark)}/first"
    for number, status in enumerate(("F", "O", "P", "P")):
        refresh.merge_first(rows.where(F.col("o_orderstatus") == status), path, "o_custkey",
                            windows.earliest_first("o_orderdate", "o_orderkey"), buckets=16, number=min(number, 2))
    return refresh.merged_rows(spark, path).select("o_custkey", "o_orderkey")


def _stored(spark, df, name, by, buckets=16):
    table = f"{name}_{uuid.uuid4().hex}"
    return writers.save_bucketed(df, f"{q.scratch(spark)}/{name}", by, buckets, table)


@query(t.ORACLE["posting_skill_joined"])
def colocated_skill_mentions(spark, d):
    by = ["posting_id", "data_source"]
    counts = _stored(spark, marts.posting_counts(s.postings(spark, d)), "counts", by)
    return marts.skill_mentions(_stored(spark, s.skills(spark, d), "skills", by), counts)


@query(q.ORACLE["left_chain"])
def colocated_left_chain(spark, d):
    turns = s.table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), "role")
    return joins.left_chain(
        _stored(spark, s.table(spark, d, "documents").select("doc_id"), "documents", ["doc_id"]),
        _stored(spark, s.table(spark, d, "labels").select("doc_id", "quality"), "labels", ["doc_id"]),
        _stored(spark, turns, "turns", ["doc_id"]), on="doc_id")


@query("""
SELECT data_source, month, count(DISTINCT company) AS companies
FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 'closed' ELSE 'open' END AS data_source,
    strftime(o_orderdate, '%Y-%m') AS month, nullif(o_custkey % 700, 3) AS company FROM orders)
GROUP BY GROUPING SETS ((data_source, month), (data_source), ())""")
def distinct_rollup(spark, d):
    """Different customers by source and month, by source and in all, the values met once."""
    rows = s.table(spark, d, "orders").select(
        F.expr("if(o_orderstatus = 'F', 'closed', 'open')").alias("data_source"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.expr("nullif(o_custkey % 700, 3)").alias("company"))
    ids = groups.dense_ids(rows, "company")
    by_month = groups.distinct_bitmaps(rows, ["data_source", "month"], "company", ids)
    by_source = groups.merge_bitmaps(by_month, "data_source")
    none = lambda c: F.lit(None).cast("string").alias(c)
    every = groups.merge_bitmaps(by_source, []).agg(F.sum(F.bitmap_count("bits")).alias("companies"))
    return groups.bitmap_counts(by_month, ["data_source", "month"], "companies").unionByName(
        groups.bitmap_counts(by_source, "data_source", "companies").withColumn("month", F.lit(None).cast("string"))).unionByName(
        every.select(none("data_source"), none("month"), "companies"))


@query("""
SELECT role, word AS value, count(*) AS n, row_number() OVER (PARTITION BY role ORDER BY count(*) DESC, word)::INTEGER AS rank
FROM (SELECT role, unnest(string_split(text, ' ')) AS word FROM conversations) WHERE trim(word) <> ''
GROUP BY 1, 2 QUALIFY rank <= 20""")
def frequent_words(spark, d):
    words = s.table(spark, d, "conversations").select("role", F.explode(F.split("text", " ")).alias("word"))
    return groups.frequent_values(words, ["role"], "word", 20)


@query("""
SELECT event_id, (props->>'k')::BIGINT AS k, if(event_id % 2 = 1, event_type, NULL) AS "late.kind",
  if(event_id % 2 = 1, [user_id::VARCHAR], NULL) AS "late.users"
FROM events""")
def flatten_found(spark, d):
    """Events whose payload has a further, nested field in half of the rows."""
    late = F.to_json(F.struct(F.from_json("props", "k bigint")["k"].alias("k"), F.struct(
        F.col("event_type").alias("kind"), F.array(F.col("user_id").cast("string")).alias("users")).alias("late")))
    payload = F.when(F.col("event_id") % 2 == 1, late).otherwise(F.col("props"))
    return readers.flatten_found(s.table(spark, d, "events").select("event_id", payload.alias("body")), "body")


@query(r.ORACLE["quality_of_marts"])
def quality_while_writing(spark, d):
    """The checks of the marts as metrics of the job that writes each; only unique columns are read again."""
    folder, metrics, done = q.scratch(spark), {}, {}
    for name, mart in r.all_marts(spark, d).items():
        if name in quality.TABLE_CHECKS:
            checked, metrics[name] = quality.observed(mart, quality.TABLE_CHECKS[name])
            done[name] = writers.save(checked, folder, "gold", name)
    return quality.report_of_writes(spark, metrics, done)


# --- raw layout and exports --------------------------------------------------------------------

_ROWS_OF = ["customer", "supplier", "part", "orders", "events", "documents"]
_KEY_OF = ["c_custkey", "s_suppkey", "p_partkey", "o_orderkey", "event_id", "doc_id"]


def _bronze_plan() -> dict[str, tuple[str, str, list[tuple[str, str]]]]:
    """Each of the 32 tables: the fixture table it is made of, that one's key and the columns written.

    Every third table lacks its last column in the files; tables that take their columns from the files get two.
    """
    plan = {}
    for i, name in enumerate([*BRONZE, *SEED_BRONZE]):
        if name in SEED_BRONZE:
            fields = [(c, "string") for c in SEEDS[SEED_BRONZE[name]][2]]
        elif BRONZE[name].schema is None:
            fields = [("Task ID", "bigint"), ("Task", "string")]
        else:
            fields = [(f.name, f.dataType.simpleString()) for f in BRONZE[name].schema.fields]
            fields = fields[:-1] if i % 3 == 0 and len(fields) > 1 else fields
        plan[name] = (_ROWS_OF[i % 6], _KEY_OF[i % 6], fields)
    return plan


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS model, count(*) AS rows, count(*) * {len(fields)} AS filled, (sum({key}) * {len(fields)})::BIGINT AS total FROM {rows}"
    for name, (rows, key, fields) in _bronze_plan().items()))
def bronze_scans(spark, d):
    """All raw tables written where the catalog has them, two files where a wildcard takes them, and scanned."""
    root = q.scratch(spark)
    for name, (rows, key, fields) in _bronze_plan().items():
        table = s.table(spark, d, rows).select(F.col(key).alias("k")).select(
            "k", *[F.col("k").cast(kind).alias(c) for c, kind in fields])
        if name in SEED_BRONZE:
            file, sep, _ = SEEDS[SEED_BRONZE[name]]
            table.drop("k").write.csv(f"{root}/seeds/{file}", header=True, sep=sep)
            continue
        file = BRONZE[name].file.removeprefix("{").split(",")[0]
        parts = [("1", table.where("k % 2 = 0")), ("2", table.where("k % 2 <> 0"))] if "*" in file else [("", table)]
        for number, part in parts:
            part.drop("k").write.parquet(f"{root}/{BRONZE[name].source}/{file.replace('*', number)}")
    counts = []
    for name, table in readers.bronze(spark, root).items():
        cells = [F.col(f"`{c}`") for c in table.columns]
        number = lambda c: F.coalesce(c.cast("double").cast("bigint"), F.lit(0).cast("bigint"))
        counts.append(table.agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("rows"), sum(F.count(c) for c in cells).alias("filled"),
            sum(F.sum(number(c)) for c in cells).cast("decimal(38,0)").alias("total")))
    return reduce(lambda a, b: a.unionByName(b), counts).withColumn("total", F.col("total").cast("bigint"))


@query("""
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders""")
def sorted_export(spark, d):
    """Orders exported in order, and the place at which each one stands in the files."""
    path = q.scratch(spark)
    writers.export_csv(s.table(spark, d, "orders").select("o_orderkey", "o_totalprice"), path,
                       [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])
    rows = spark.read.schema("o_orderkey bigint, o_totalprice double").csv(path, header=True).select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"))
    sizes = rows.groupBy("file").agg(F.count("*").alias("n"))
    before = F.sum("n").over(windows.Window.orderBy("file").rowsBetween(windows.Window.unboundedPreceding, -1))
    starts = sizes.select("file", F.coalesce(before, F.lit(0)).alias("start"))  # a row per file
    at = F.row_number().over(windows.Window.partitionBy("file").orderBy("split", "id"))
    return rows.withColumn("at", at).join(F.broadcast(starts), "file").select(
        "o_orderkey", "o_totalprice", (F.col("start") + F.col("at")).alias("place"))
