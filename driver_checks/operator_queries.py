"""Single operators and readers on the fixture tables, with their oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from driver_checks import oracle_parts as o
from driver_checks import shapes as s
from jobtide.fixed_values import NOISE_NAMES, NOISE_PATTERNS
from jobtide.functions import dates, labels, numbers, salary, text
from jobtide.operators import groups, joins, reshape, windows
from jobtide.plans import facts
from jobtide.plans.marts import QUARTILES
from jobtide.session import shared_folder
from jobtide.sources import readers, writers

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that must give the same rows."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return add


def scratch(spark) -> str:
    """A new folder for files a query writes, where all executors see it."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


# --- readers and writers ------------------------------------------------------------------


@query("SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1")
def parquet_scan(spark, d):
    root, folder = d.rsplit("/", 1)
    lines = readers.read_raw(spark, root, folder, "line*.parquet")
    return groups.group_stats(
        lines, "l_returnflag", n=F.count(F.lit(1)), quantity=numbers.round_to(F.sum("l_quantity"), 2))


@query("""
SELECT event_id, event_type AS "event.type", (props->>'k')::BIGINT AS "event.props.k", user_id AS "user"
FROM events""")
def flatten_json(spark, d):
    nested = s.table(spark, d, "events").select(
        "event_id",
        F.struct(F.col("event_type").alias("type"), F.from_json("props", "k bigint").alias("props"))
        .alias("event"),
        F.col("user_id").alias("user"),
    )
    return readers.flatten_json(nested)


@query("""
SELECT CASE l_returnflag WHEN 'R' THEN 'unknown' ELSE l_returnflag END AS "seriesID", l_orderkey AS id,
  v AS value, if(w = 1, 1 - l_discount, NULL) AS "calculations.net_changes.1"
FROM (SELECT *, unnest([l_quantity, l_extendedprice]) AS v, unnest([1, 2]) AS w FROM lineitem)""")
def explode_series(spark, d):
    def observation(value, change):
        changes = F.struct(F.struct(change.alias("1")).alias("net_changes"))
        return F.struct(F.col("l_orderkey").alias("id"), value.alias("value"), changes.alias("calculations"))

    data = F.array(
        observation(F.col("l_quantity"), 1 - F.col("l_discount")),
        observation(F.col("l_extendedprice"), F.lit(None).cast("double")),
    )
    series = F.struct(F.nullif("l_returnflag", F.lit("R")).alias("seriesID"), data.alias("data"))
    payload = s.table(spark, d, "lineitem").select(F.struct(F.array(series).alias("series")).alias("Results"))
    return readers.explode_series(payload)


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS date, if(event_type = 'click', value, NULL) AS click,
  if(event_type = 'view', value, NULL) AS view
FROM events""")
def wide_from_map(spark, d):
    day = F.create_map(
        F.date_format("ts", "yyyy-MM-dd"), F.create_map(F.col("event_type"), F.col("value")))
    body = F.to_json(F.struct(F.array(F.lit("click"), F.lit("view")).alias("series_ids"), day.alias("data")))
    return readers.wide_from_map(
        s.table(spark, d, "events").select(body.alias("value")), ["click", "view"])


@query("""
SELECT c_name AS "NAME", c_custkey::VARCHAR AS "KEY", NULL::VARCHAR AS "NONE",
  c_mktsegment AS "metro/segment"
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def header_rows(spark, d):
    header = F.array(F.lit("KEY"), F.lit("NAME"), F.lit("metro/segment"))
    row = F.array(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    payload = s.table(spark, d, "customer").select(F.to_json(F.array(header, row)).alias("value"))
    return readers.header_rows(
        payload, ["NAME", "KEY", "NONE", "metro/segment"], keep=["BUILDING", "MACHINERY"])


_CSV_LINES = """
SELECT c_custkey::VARCHAR AS id, 'a, "b"' || c_name AS name, c_mktsegment AS segment, c_nationkey FROM customer"""


def _customer_csv(spark, d) -> str:
    """Customers as CSV lines: nation 3 lacks a field, nation 4 has one too many, nation 5 has NULs."""
    folder = scratch(spark)
    quoted = F.concat(F.lit('"a, ""b""'), "c_name", F.lit('"'))
    segment = F.when(F.col("c_nationkey") == 5, F.concat(F.lit("\u0000"), "c_mktsegment")).otherwise(
        F.col("c_mktsegment"))
    fields = (
        F.when(F.col("c_nationkey") == 3, F.concat_ws(",", "c_custkey", quoted))
        .when(F.col("c_nationkey") == 4, F.concat_ws(",", "c_custkey", quoted, segment, F.lit("x")))
        .otherwise(F.concat_ws(",", "c_custkey", quoted, segment))
    )
    s.table(spark, d, "customer").select(fields).write.text(folder + "/csv")
    return folder + "/csv"


@query(f"SELECT id, name, segment FROM ({_CSV_LINES}) WHERE c_nationkey NOT IN (3, 4)")
def csv_clean(spark, d):
    # The parts have no header line, so the reader's schema is used with header lines off.
    good, _ = readers.read_csv_clean(
        spark, _customer_csv(spark, d), ["id", "name", "segment"], header=False)
    return good


@query(f"""
SELECT id || ',"a, ""b""' || name[7:] || '"' || if(c_nationkey = 4, ',' || segment || ',x', '') AS "_bad"
FROM ({_CSV_LINES}) WHERE c_nationkey IN (3, 4)""")
def csv_rejects(spark, d):
    _, bad = readers.read_csv_clean(
        spark, _customer_csv(spark, d), ["id", "name", "segment"], header=False, multi_line=False)
    return bad


@query(f"""
SELECT id, name, segment, NULL::VARCHAR AS "_bad" FROM ({_CSV_LINES}) WHERE c_nationkey NOT IN (3, 4)
UNION ALL
SELECT NULL, NULL, NULL, id || ',"a, ""b""' || name[7:] || '"' || if(c_nationkey = 4, ',' || segment || ',x', '')
FROM ({_CSV_LINES}) WHERE c_nationkey IN (3, 4)""")
def csv_to_parquet(spark, d):
    folder = scratch(spark)
    # Separator and quote that no line has: lines and header are written as they are.
    lines = spark.read.text(_customer_csv(spark, d)).withColumnRenamed("value", "id,name,segment")
    lines.write.csv(f"{folder}/in/customer", header=True, sep="\u0001", quote="\u0002", escape="\u0002",
                    ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    written = readers.csv_to_parquet(spark, f"{folder}/in", f"{folder}/out")
    good = [spark.read.parquet(f"{folder}/out/{name}") for name in written]
    bad = [spark.read.parquet(f"{folder}/out/_rejects/{name}") for name, (_, n) in written.items() if n]
    none = [F.lit(None).cast("string").alias(c) for c in ("id", "name", "segment")]
    return reshape.union_sources(
        *[t.select("*", F.lit(None).cast("string").alias("_bad")) for t in good],
        *[t.select(*none, "_bad") for t in bad])


@query("SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_type FROM part")
def tsv_round_trip(spark, d):
    folder = scratch(spark)
    s.table(spark, d, "part").select("p_partkey", "p_name", "p_type").write.csv(
        folder + "/tsv", header=True, sep="\t")
    return readers.read_tsv(spark, folder + "/tsv")


@query("""
SELECT DISTINCT r_name AS state, n_name AS city, n_nationkey::VARCHAR AS cbsa_fips
FROM customer, nation, region WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey""")
def seed_csv(spark, d):
    folder = scratch(spark)
    places = s.table(spark, d, "customer").join(
        s.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).join(s.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("state"), F.col("n_name").alias("city"), F.col("n_nationkey").alias("cbsa_fips"))
    places.distinct().write.csv(f"{folder}/state_to_cbsa_bridge.csv", header=True)
    return readers.read_seed(spark, folder, "state_to_cbsa_bridge")


@query("SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders")
def save_table(spark, d):
    rows = s.table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return writers.save(rows, scratch(spark), "silver", "orders", ["o_orderstatus"])


@query("""
SELECT c_custkey, 'data engineer' AS _search_query, 'all' AS _search_location, '2026-03-01T08:00:00' AS _fetched_at
FROM customer""")
def tag_batch(spark, d):
    rows = s.table(spark, d, "customer").select("c_custkey")
    return readers.tag_batch(rows, "data engineer", "", "2026-03-01T08:00:00")


@query("""
SELECT event_id, nullif(user_id, 7) AS id FROM events
QUALIFY user_id = 7 OR row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def dedup_keep_null(spark, d):
    rows = s.table(spark, d, "events").withColumn("id", F.nullif("user_id", F.lit(7)))
    return readers.dedup_batch(rows, "id", ["ts", "event_id"]).select("event_id", "id")


# --- projections and predicates -----------------------------------------------------------

_PERIOD_SQL = """
x AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS hi, l_discount,
    CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN l_quantity ELSE l_extendedprice END AS seen,
    MAP {'A': 'MONTHLY', 'N': 'WEEKLY', 'R': 'BIWEEKLY'}[l_returnflag] AS said
  FROM lineitem
),
y AS (
  SELECT *, CASE WHEN seen IS NULL THEN said WHEN seen >= 250000 THEN 'YEARLY'
    WHEN seen >= 15000 THEN if(said = 'MONTHLY' AND seen <= 50000, said, 'YEARLY')
    WHEN seen >= 4000 THEN said
    WHEN seen >= 1000 THEN if(said = 'MONTHLY' AND seen < 2500, 'WEEKLY', said)
    ELSE if(said = 'WEEKLY' AND seen >= 200, said, 'HOURLY') END AS period
  FROM x
)"""


def _observed(spark, d):
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    return s.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(line == 2, F.col("l_quantity")).when(line > 2, F.col("l_extendedprice")).alias("seen"),
        F.when(flag == "A", "MONTHLY").when(flag == "N", "WEEKLY").otherwise("BIWEEKLY").alias("said"),
    )


@query(f"WITH {_PERIOD_SQL} SELECT l_orderkey, l_linenumber, l_partkey, seen, period FROM y")
def period_correct(spark, d):
    return _observed(spark, d).select(
        "l_orderkey", "l_linenumber", "l_partkey", "seen",
        salary.correct_period(F.col("seen"), F.col("said")).alias("period"))


@query(f"""
WITH {_PERIOD_SQL} SELECT l_orderkey, l_linenumber, l_partkey,
  seen * MAP {{'HOURLY': 2080, 'WEEKLY': 52, 'BIWEEKLY': 26, 'MONTHLY': 12, 'YEARLY': 1}}[period] AS yearly
FROM y""")
def annualise(spark, d):
    period = salary.correct_period(F.col("seen"), F.col("said"))
    return _observed(spark, d).select(
        "l_orderkey", "l_linenumber", "l_partkey", salary.annualise(F.col("seen"), period).alias("yearly"))


@query("""
SELECT l_orderkey, l_partkey, l_linenumber,
  CASE WHEN l_returnflag = 'A' AND yearly BETWEEN 15000 AND 1000000 THEN yearly END AS estimate
FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN (l_extendedprice * 12 + l_extendedprice * 2 * 12) / 2
  ELSE l_extendedprice * 12 END AS yearly FROM lineitem)""")
def salary_estimate(spark, d):
    price = F.col("l_extendedprice")
    return s.table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        salary.salary_estimate(
            price, F.lit(None).cast("double"), F.when(F.col("l_linestatus") == "O", price * 2),
            F.lit("MONTHLY"), F.when(F.col("l_returnflag") == "A", "usd").otherwise("eur")).alias("estimate"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority = '2-HIGH'
    ELSE o_orderpriority IN ('1-URGENT', '2-HIGH') END AS with_default,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority = '2-HIGH' END AS without
FROM orders""")
def remote_flag(spark, d):
    work = F.when(F.col("o_orderstatus") == "P", F.lit(None)).when(
        F.col("o_orderpriority") == "2-HIGH", "Full REMOTE").otherwise("on site")
    title = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Remote lead").otherwise("lead")
    return s.table(spark, d, "orders").select(
        "o_orderkey", labels.remote_flag(work, title, default=False).alias("with_default"),
        labels.remote_flag(work).alias("without"))


def _words(spark, d):
    docs = s.table(spark, d, "documents").where(text.not_blank(F.col("text"))).select("doc_id", "text")
    return reshape.explode_csv(docs, "text", "item").select(
        "doc_id", text.norm(F.col("item")).alias("item"))


_ITEMS = "SELECT doc_id, lower(trim(unnest(string_split(text, ',')))) AS item FROM documents WHERE trim(text) <> ''"
_NOISE = " OR ".join("item ILIKE '" + p.replace("'", "''") + "'" for p in NOISE_PATTERNS)


@query(f"SELECT DISTINCT doc_id, item FROM ({_ITEMS})")
def explode_words(spark, d):
    return _words(spark, d).distinct()


@query(f"""
SELECT doc_id, item FROM ({_ITEMS}) WHERE length(item) BETWEEN 2 AND 50 AND NOT ({_NOISE})
AND item NOT IN ({', '.join(f"'{n}'" for n in NOISE_NAMES)})""")
def noise_filter(spark, d):
    return facts.drop_non_skills(_words(spark, d), "item")


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'employment' WHEN 'O' THEN 'labor_demand' ELSE 'other' END
  AS category
FROM orders""")
def series_category(spark, d):
    name = F.when(F.col("o_orderstatus") == "F", "total nonfarm payrolls").when(
        F.col("o_orderstatus") == "O", "jolts quits").otherwise("weather")
    return s.table(spark, d, "orders").select("o_orderkey", labels.series_category(name).alias("category"))


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN false END AS flag,
  CASE l_linestatus WHEN 'O' THEN if(l_tax > 0.04, 'aligned', 'market_only') ELSE 'onet_only' END AS gap,
  l_quantity >= 10 AND l_linenumber > 0 AND l_quantity - l_linenumber > 0.1 * l_linenumber AS trending
FROM lineitem""")
def row_labels(spark, d):
    flag = F.when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "N", "N").otherwise("?")
    market = F.col("l_linestatus") == "O"
    return s.table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        text.yes_no(flag).alias("flag"),
        labels.gap_direction(~market | (F.col("l_tax") > 0.04), market).alias("gap"),
        labels.is_trending(F.col("l_quantity"), F.col("l_linenumber")).alias("trending"))


# --- scalar functions ---------------------------------------------------------------------


@query("""
SELECT c_custkey, lower(trim('  ' || c_name || ' ')) AS normal, string_split(c_name, '#')[2] AS second,
  string_split(c_name, '#')[3] AS third, (c_mktsegment || '-0000.00')[1:7] AS code, c_mktsegment[1:2] AS prefix,
  lpad(replace('M' || c_nationkey, 'M', ''), 2, '0') AS month, length(c_name) AS size,
  c_mktsegment ILIKE '%ui%' OR c_mktsegment ILIKE 'mach%' AS some, upper(c_name) AS big
FROM customer""")
def text_functions(spark, d):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return s.table(spark, d, "customer").select(
        "c_custkey",
        text.norm(F.concat(F.lit("  "), name, F.lit(" "))).alias("normal"),
        text.split_part(name, "#", 1).alias("second"),
        text.split_part(name, "#", 2).alias("third"),
        text.soc_code(F.concat(segment, F.lit("-0000.00"))).alias("code"),
        text.soc_prefix(segment).alias("prefix"),
        text.pad_month(F.concat(F.lit("M"), F.col("c_nationkey").cast("string"))).alias("month"),
        F.length(name).cast("bigint").alias("size"),
        text.ilike_any(segment, ["%ui%", "mach%"]).alias("some"),
        F.upper(name).alias("big"),
    )


@query("""
SELECT event_id, date_trunc('month', ts)::TIMESTAMP AS month, year(ts) AS year, quarter(ts) AS quarter,
  month(ts) AS month_num, isodow(ts)::INTEGER AS weekday, isodow(ts) >= 6 AS weekend,
  strftime(ts, '%Y%m%d')::INTEGER AS key, monthname(ts) AS name, ts + INTERVAL 40 DAY AS later,
  CASE WHEN user_id BETWEEN 1 AND 12 THEN make_date(2024, user_id, 1) END AS period,
  CASE WHEN user_id > 0 THEN make_timestamp_ms(user_id * 1000000) END AS from_ms,
  CASE WHEN user_id > 0 THEN make_timestamp_ms(user_id * 1000000000) END AS from_s,
  ts::DATE AS day
FROM events""")
def date_functions(spark, d):
    ts, user = F.col("ts"), F.col("user_id")
    code = F.concat(F.lit("M"), F.lpad(user.cast("string"), F.greatest(F.length(user.cast("string")), F.lit(2)), F.lit("0")))
    return s.table(spark, d, "events").select(
        "event_id",
        dates.month_start(ts).alias("month"),
        *dates.date_parts(ts, month="month_num"),
        dates.iso_weekday(ts).alias("weekday"),
        dates.is_weekend(ts).alias("weekend"),
        dates.date_key(ts).alias("key"),
        dates.month_name(ts).alias("name"),
        dates.add_part(ts, 40, "day").alias("later"),
        dates.period_date(F.lit("2024"), code).alias("period"),
        dates.from_epoch_ms(user * 1000000).alias("from_ms"),
        dates.from_epoch_s(user * 1000000).alias("from_s"),
        dates.safe_date(ts.cast("string")).alias("day"),
    )


@query("""
SELECT o_orderkey, round(o_totalprice)::INTEGER AS whole, round(o_totalprice / 1000, 1) AS thousands,
  round((o_custkey / nullif(o_orderkey, 0))::DOUBLE, 4) AS ratio, try_cast(o_orderpriority[1:1] AS DOUBLE) AS level,
  try_cast(o_orderpriority AS DOUBLE) AS nothing, abs(o_custkey - 500) AS distance,
  CASE WHEN o_custkey >= 5 THEN o_totalprice END AS gated,
  round((o_totalprice - o_custkey) / nullif(o_custkey, 0), 4) AS growth
FROM orders""")
def number_functions(spark, d):
    price, cust = F.col("o_totalprice"), F.col("o_custkey")
    return s.table(spark, d, "orders").select(
        "o_orderkey",
        numbers.rounded_int(price).alias("whole"),
        numbers.round_to(price / 1000, 1).alias("thousands"),
        numbers.safe_ratio(cust, F.col("o_orderkey"), 4).alias("ratio"),
        numbers.safe_cast(F.left("o_orderpriority", F.lit(1)), "double").alias("level"),
        numbers.safe_cast(F.col("o_orderpriority"), "double").alias("nothing"),
        F.abs(cust - 500).alias("distance"),
        numbers.gate(price, cust).alias("gated"),
        numbers.growth(price, cust, 4).alias("growth"),
    )


# --- joins --------------------------------------------------------------------------------


@query("SELECT n_nationkey, n_name, n_regionkey, r_name, c_custkey FROM nation, region, customer "
       "WHERE n_regionkey = r_regionkey AND c_nationkey = n_nationkey")
def inner_on(spark, d):
    region = s.table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    customer = s.table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return joins.inner_on(joins.inner_on(s.table(spark, d, "nation"), region, "n_regionkey"), customer, "n_nationkey")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, n FROM lineitem JOIN (
  SELECT l_orderkey, l_partkey, l_suppkey, if(l_returnflag = 'A', l_linestatus, l_returnflag) AS l_linestatus,
    count(*) AS n
  FROM lineitem GROUP BY ALL) USING (l_orderkey, l_partkey, l_suppkey, l_linestatus)""")
def inner_on_four_keys(spark, d):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linestatus"]
    lines = s.table(spark, d, "lineitem")
    # Lines that were not returned keep their return flag as status, which no line has.
    status = F.when(F.col("l_returnflag") == "A", F.col("l_linestatus")).otherwise(F.col("l_returnflag"))
    returned = groups.group_stats(lines.withColumn("l_linestatus", status), keys, n=F.count(F.lit(1)))
    return joins.inner_on(lines, returned, keys).select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "n")


@query("""
SELECT event_id, event_type AS key, coalesce(MAP {'click': 'Click on a link', 'view': 'Page view'}[event_type],
  event_type) AS name
FROM events""")
def series_lookup(spark, d):
    names = joins.inline_mapping(spark, [("click", "Click on a link"), ("view", "Page view")], ["key", "name"])
    rows = s.table(spark, d, "events").select("event_id", F.col("event_type").alias("key"))
    return joins.lookup_or_self(rows, names, "key", "name")


@query("SELECT p_partkey, CASE p_name WHEN 'hot gear' THEN 'gear' WHEN 'red widget' THEN 'widget' ELSE p_name END "
       "AS p_name FROM part")
def dictionary_normalise(spark, d):
    words = joins.inline_mapping(spark, [("hot gear", "gear"), ("red widget", "widget")], ["raw", "word"])
    return joins.apply_dictionary(s.table(spark, d, "part").select("p_partkey", "p_name"), words, "p_name", "raw", "word")


@query("SELECT l_orderkey, l_partkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey "
       "WHERE p_size > 10")
def resolve_codes(spark, d):
    names = s.table(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.when(F.col("p_size") > 10, F.col("p_name")).alias("p_name"))
    lines = s.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return joins.resolve_codes(lines, names, "l_partkey", "p_name")


@query("""
SELECT p_partkey, p_type, code AS onet_soc_code, code[1:7] AS soc_code,
  if(code IS NULL, 'unmatched', 'exact_match') AS soc_match_type
FROM part LEFT JOIN (SELECT p_type AS t, '15-' || lpad(min(p_partkey)::VARCHAR, 4, '0') || '.00' AS code
  FROM part WHERE p_type <> 'PROMO' GROUP BY 1) ON p_type = t""")
def match_titles(spark, d):
    part = s.table(spark, d, "part")
    code = F.concat(F.lit("15-"), F.lpad(F.min("p_partkey").cast("string"), 4, "0"), F.lit(".00"))
    known = part.where(F.col("p_type") != "PROMO").groupBy(F.col("p_type").alias("title_lower")).agg(
        code.alias("onet_soc_code")).withColumn("soc_code", text.soc_code(F.col("onet_soc_code")))
    return joins.match_titles(part.select("p_partkey", "p_type"), known, "p_type")


_GEO_SQL = """
SELECT s_suppkey, a.city AS city_by_state, a.county AS county_by_state, a.state AS state_by_state,
  b.city AS city_by_county, b.county AS county_by_county, b.state AS state_by_county
FROM (SELECT s_suppkey, n_name, if(s_acctbal > 5000, n_name, r_name || ' county') AS part_2
      FROM supplier, nation, region WHERE s_nationkey = n_nationkey AND n_regionkey = r_regionkey) x
LEFT JOIN places a ON x.n_name = a.city AND x.part_2 = a.state
LEFT JOIN places b ON x.n_name = b.city AND lower(x.part_2) = lower(b.county)"""


@query("""
WITH places AS (
  SELECT c.n_name AS city, r_name || ' County' AS county, t.n_name AS state
  FROM nation c, nation t, region WHERE c.n_regionkey = t.n_regionkey AND r_regionkey = c.n_regionkey
)""" + _GEO_SQL)
def geo_match(spark, d):
    nation = s.table(spark, d, "nation").join(
        s.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = s.table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("part_1"),
        F.when(F.col("s_acctbal") > 5000, F.col("n_name")).otherwise(
            F.concat("r_name", F.lit(" county"))).alias("part_2"))
    return joins.geo_match(rows, s.places(spark, d), "part_1", "part_2").drop("part_1", "part_2")


@query("""
SELECT coalesce(a.p_brand, b.p_brand) AS p_brand, coalesce(a.p_name, b.p_name) AS p_name,
  a.p_name IS NOT NULL AS listed, b.p_name IS NOT NULL AS sold, n
FROM (SELECT DISTINCT p_brand, if(p_size > 25, p_name, 'small ' || p_name) AS p_name FROM part) a
FULL JOIN (SELECT p_brand, if(p_size < 40, p_name, 'large ' || p_name) AS p_name, count(*) AS n
  FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY ALL) b ON a.p_brand = b.p_brand AND a.p_name = b.p_name""")
def compare_sets(spark, d):
    part = s.table(spark, d, "part")
    keys = ["p_brand", "p_name"]
    # Each side names some parts in a way of its own, so both have keys that the other lacks.
    listed = part.withColumn("p_name", F.expr("if(p_size > 25, p_name, 'small ' || p_name)"))
    sold = s.table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "p_name", F.expr("if(p_size < 40, p_name, 'large ' || p_name)"))
    return joins.compare_sets(
        listed.select(*keys).distinct(),
        groups.group_stats(sold, keys, n=F.count(F.lit(1))), keys, "listed", "sold")


@query("""
WITH a AS (SELECT if(c_nationkey < 12, c_nationkey, 100 + c_nationkey) AS nation, c_mktsegment AS who, c_custkey AS id FROM customer),
b AS (SELECT if(s_nationkey > 3, s_nationkey, 200 + s_nationkey) AS nation, 'supplier' AS who, s_suppkey AS id FROM supplier)
FROM a UNION ALL SELECT * FROM b WHERE nation NOT IN (SELECT nation FROM a)""")
def prefer_source(spark, d):
    # Each side has some nations under numbers of its own.
    first = s.table(spark, d, "customer").select(
        F.expr("if(c_nationkey < 12, c_nationkey, 100 + c_nationkey)").alias("nation"),
        F.col("c_mktsegment").alias("who"), F.col("c_custkey").alias("id"))
    second = s.table(spark, d, "supplier").select(
        F.expr("if(s_nationkey > 3, s_nationkey, 200 + s_nationkey)").alias("nation"),
        F.lit("supplier").alias("who"), F.col("s_suppkey").alias("id"))
    return joins.prefer_source(first, second, "nation")


@query("SELECT o_custkey, count(DISTINCT o_orderdate) AS days FROM orders GROUP BY 1 HAVING days >= 10")
def qualified(spark, d):
    return groups.qualified(s.table(spark, d, "orders"), "o_custkey", "o_orderdate", 10, "days")


@query("""
SELECT o_custkey FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)
GROUP BY 1 HAVING sum(n) >= 12""")
def qualified_sum(spark, d):
    counted = groups.group_stats(s.table(spark, d, "orders"), ["o_custkey", "o_orderstatus"], n=F.count(F.lit(1)))
    return groups.qualified_sum(counted, "o_custkey", "n", 12)


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
  SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 20)""")
def for_top_groups(spark, d):
    orders = s.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    counted = groups.group_stats(orders, "o_custkey", n=F.count(F.lit(1)))
    return joins.for_top_groups(orders, counted, "o_custkey", [F.col("n").desc(), F.col("o_custkey").asc()], 20)


@query("""
SELECT c_custkey, CASE WHEN r_name IN ('AMERICA', 'ASIA', 'EUROPE') THEN n_nationkey::VARCHAR END AS cbsa_fips
FROM customer, nation, region WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey""")
def attach_metro(spark, d):
    rows = s.table(spark, d, "customer").join(
        s.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        s.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "c_custkey", F.concat(F.lit(" "), F.lower("r_name")).alias("state"), F.col("n_name").alias("city"))
    return joins.attach_metro(rows, s.metro_bridge(spark, d)).select("c_custkey", "cbsa_fips")


@query(f"""
WITH {o.rated('p_name')}
SELECT p_partkey, importance_value, level_value
FROM part LEFT JOIN rated ON p_name = lower(skill_name) AND onet_soc_code = '15-0002.00'""")
def attach_ratings(spark, d):
    rows = s.table(spark, d, "part").select(
        "p_partkey", F.lit("15-0002.00").alias("onet_soc_code"), F.col("p_name").alias("skill_name"))
    rated = s.dim_skills(spark, d).drop("element_id")
    return joins.attach_ratings(rows, rated, "onet_soc_code", "skill_name").drop("onet_soc_code", "skill_name")


@query("""
SELECT o_orderkey, o_orderstatus, n FROM orders
LEFT JOIN (SELECT if(o_orderstatus = 'P', 'pending', o_orderstatus) AS o_orderstatus, count(*) AS n FROM orders
  GROUP BY 1) USING (o_orderstatus)""")
def attach_totals(spark, d):
    orders = s.table(spark, d, "orders")
    renamed = orders.withColumn("o_orderstatus", F.expr("if(o_orderstatus = 'P', 'pending', o_orderstatus)"))
    totals = groups.group_stats(renamed, "o_orderstatus", n=F.count(F.lit(1)))
    return joins.attach_totals(orders.select("o_orderkey", "o_orderstatus"), totals, "o_orderstatus")


@query("""
SELECT d.doc_id, quality, role FROM documents d LEFT JOIN labels USING (doc_id)
LEFT JOIN conversations ON conv_id = d.doc_id""")
def left_chain(spark, d):
    turns = s.table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), "role")
    return joins.left_chain(
        s.table(spark, d, "documents").select("doc_id"), s.table(spark, d, "labels").select("doc_id", "quality"),
        turns, on="doc_id")


# --- aggregations -------------------------------------------------------------------------


@query("""
SELECT o_orderstatus, count(*) AS n, count(nullif(o_orderpriority, '5-LOW')) AS known,
  count(DISTINCT o_custkey) AS customers, count(DISTINCT date_trunc('month', o_orderdate)) AS months,
  min(o_orderdate) AS first_day, max(o_totalprice) AS highest, round(avg(o_totalprice), 4) AS mean,
  count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent
FROM orders GROUP BY 1 HAVING count(*) > 10""")
def group_stats(spark, d):
    stats = groups.group_stats(
        s.table(spark, d, "orders"), "o_orderstatus",
        n=F.count(F.lit(1)), known=F.count(F.nullif("o_orderpriority", F.lit("5-LOW"))),
        customers=F.countDistinct("o_custkey"),
        months=F.countDistinct(dates.month_start(F.col("o_orderdate"))),
        first_day=F.min("o_orderdate"), highest=F.max("o_totalprice"),
        mean=numbers.round_to(F.avg("o_totalprice"), 4),
        urgent=numbers.count_where(F.col("o_orderpriority") == "1-URGENT"),
    )
    return groups.having(stats, F.col("n") > 10)


@query("""
SELECT l_suppkey, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS flag,
  quantile_cont(v, 0.25) AS salary_p25, median(v) AS median_salary, quantile_cont(v, 0.75) AS salary_p75
FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN round(l_extendedprice)::INTEGER - 20000 END AS v FROM lineitem)
WHERE v IS NOT NULL GROUP BY ALL""")
def exact_percentiles(spark, d):
    value = F.when(F.col("l_linestatus") == "O", numbers.rounded_int(F.col("l_extendedprice")) - 20000)
    rows = s.table(spark, d, "lineitem").select(
        "l_suppkey", F.nullif("l_returnflag", F.lit("R")).alias("flag"), value.alias("v"))
    return groups.exact_percentiles(rows, ["l_suppkey", "flag"], "v", QUARTILES)


_PERCENTILES = ", ".join(f"round(quantile_cont(v, {p}), 2) AS {n}" for n, p in QUARTILES.items())


def _rounded(df, keys):
    found = groups.exact_percentiles(df, keys, "v", QUARTILES)
    return found.select(*keys, *[numbers.round_to(F.col(n), 2).alias(n) for n in QUARTILES])


@query(f"""
SELECT l_suppkey, {_PERCENTILES} FROM (SELECT l_suppkey, l_extendedprice * (0.5 - l_discount * 10) AS v FROM lineitem)
GROUP BY 1""")
def percentiles_of_doubles(spark, d):
    value = F.col("l_extendedprice") * (F.lit(0.5) - F.col("l_discount") * 10)
    return _rounded(s.table(spark, d, "lineitem").select("l_suppkey", value.alias("v")), ["l_suppkey"])


@query(f"""
SELECT l_returnflag, {_PERCENTILES}
FROM (SELECT l_returnflag, (l_orderkey::BIGINT - 500) * 3000000000 + l_linenumber AS v FROM lineitem) GROUP BY 1""")
def percentiles_of_bigints(spark, d):
    value = (F.col("l_orderkey").cast("bigint") - 500) * F.lit(3000000000) + F.col("l_linenumber")
    return _rounded(s.table(spark, d, "lineitem").select("l_returnflag", value.alias("v")), ["l_returnflag"])


@query("""
SELECT l_suppkey, year(l_shipdate) AS year, max(l_quantity) FILTER (l_linestatus = 'F') AS closed,
  max(l_quantity) FILTER (l_linestatus = 'O' AND l_returnflag = 'A') AS open
FROM lineitem GROUP BY ALL HAVING closed IS NOT NULL AND open IS NOT NULL""")
def rating_pivot(spark, d):
    scale = F.when(F.col("l_linestatus") == "F", "F").when(F.col("l_returnflag") == "A", "OA")
    rows = s.table(spark, d, "lineitem").select(
        "l_suppkey", dates.year_of(F.col("l_shipdate")).alias("year"), scale.alias("scale"), "l_quantity")
    return groups.rating_pivot(rows, ["l_suppkey", "year"], "scale", "l_quantity", {"F": "closed", "OA": "open"})


@query("""
SELECT o_custkey, """ + ", ".join(
    f"coalesce(sum(o_custkey * 1.0::DOUBLE) FILTER (o_orderpriority = '{p}'), 0) AS {n}" for p, n in
    [("1-URGENT", "urgent"), ("2-HIGH", "high"), ("5-LOW", "low")]) + " FROM orders GROUP BY 1")
def category_pivot(spark, d):
    rows = s.table(spark, d, "orders").withColumn("v", F.col("o_custkey").cast("double"))
    return groups.category_pivot(
        rows, "o_custkey", "o_orderpriority", "v", {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"})


@query("""
SELECT l_suppkey, string_agg(DISTINCT upper(p_brand), ', ' ORDER BY upper(p_brand)) AS brands
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def sorted_distinct(spark, d):
    return groups.agg_sorted_distinct(
        s.lines_with_parts(spark, d), "l_suppkey", F.upper("p_brand"), "brands")


@query("""
SELECT l_suppkey, list_sort(list(DISTINCT p_type) FILTER (p_type <> 'PROMO')) AS types
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'PROMO' GROUP BY 1""")
def distinct_list(spark, d):
    return groups.agg_distinct_list(
        s.lines_with_parts(spark, d), "l_suppkey", F.nullif("p_type", F.lit("PROMO")), "types")


_RANKED = """
SELECT l_suppkey, p_name, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, p_name) AS r
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_name"""


@query(f"SELECT l_suppkey, string_agg(p_name, ', ' ORDER BY r) AS best FROM ({_RANKED}) WHERE r <= 5 GROUP BY 1")
def top_names(spark, d):
    return groups.agg_top_names(s.lines_with_parts(spark, d), "l_suppkey", "p_name", 5, "best")


@query(f"SELECT l_suppkey, p_name AS favourite FROM ({_RANKED}) WHERE r = 1")
def mode_per_group(spark, d):
    return groups.mode_per_group(s.lines_with_parts(spark, d), "l_suppkey", "p_name", "favourite")


@query("""
SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS report_month, o_orderstatus, max(o_totalprice) AS o_totalprice
FROM orders GROUP BY ALL""")
def monthly(spark, d):
    return groups.monthly(s.table(spark, d, "orders"), "o_orderdate", "o_orderstatus", "o_totalprice", F.max)


@query(" UNION ALL ".join(f"SELECT '{t}' AS model, count(*) AS rows FROM {t}" for t in
                          ["customer", "orders", "lineitem", "events", "documents"]))
def row_counts(spark, d):
    names = ["customer", "orders", "lineitem", "events", "documents"]
    return groups.row_counts({n: s.table(spark, d, n) for n in names})


# --- windows ------------------------------------------------------------------------------


@query("""
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_key(spark, d):
    events = s.table(spark, d, "events")
    return windows.latest_per_key(events, "user_id", windows.latest_first("ts", "event_id")).select(
        "user_id", "event_id", "event_type")


@query("""
SELECT c_name AS name, src, id FROM (
  SELECT 'Customer#' || lpad(s_suppkey::VARCHAR, 9, '0') AS c_name, 'supplier' AS src, s_suppkey AS id FROM supplier
  UNION ALL SELECT c_name, 'customer', c_custkey FROM customer
  UNION ALL SELECT c_name, 'customer', c_custkey + 1 FROM customer)
QUALIFY row_number() OVER (PARTITION BY c_name ORDER BY src DESC, id) = 1""")
def priority_dedup(spark, d):
    customer = s.table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.lit("customer").alias("src"), F.col("c_custkey").alias("id"))
    supplier = s.table(spark, d, "supplier").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("name"),
        F.lit("supplier").alias("src"), F.col("s_suppkey").alias("id"))
    both = reshape.union_sources(supplier, customer, customer.withColumn("id", F.col("id") + 1))
    return windows.first_by_priority(both, "name", F.when(F.col("src") == "supplier", 0).otherwise(1), ["id"])


@query("""
SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS rank FROM orders) WHERE rank <= 3""")
def top_k_per_group(spark, d):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return windows.top_k_per_group(s.table(spark, d, "orders"), "o_custkey", order, 3, rank="rank").select(
        "o_custkey", "o_orderkey", "rank")


_MONTHS = "SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS m, o_orderstatus AS k, count(*) AS n FROM orders GROUP BY ALL"


def _months(spark, d):
    rows = s.table(spark, d, "orders").select(
        dates.month_start(F.col("o_orderdate")).alias("m"), F.col("o_orderstatus").alias("k"))
    return groups.group_stats(rows, ["m", "k"], n=F.count(F.lit(1)))


@query(f"SELECT *, lag(n) OVER (PARTITION BY k ORDER BY m) AS before FROM ({_MONTHS})")
def with_prev(spark, d):
    return windows.with_prev(_months(spark, d), "k", "m", {"before": "n"})


@query(f"SELECT *, lag(n, 12) OVER (PARTITION BY k ORDER BY m) AS n_12m_ago FROM ({_MONTHS})")
def yoy(spark, d):
    return windows.yoy(_months(spark, d), "k", "m", "n")


@query(f"WITH x AS ({_MONTHS}) SELECT a.*, b.n AS n_12m_ago FROM x a LEFT JOIN x b "
       "ON a.k = b.k AND a.m = b.m + INTERVAL 12 MONTH")
def yoy_calendar(spark, d):
    return windows.yoy_calendar(_months(spark, d), "k", "m", "n")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k(spark, d):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return windows.top_k(s.table(spark, d, "orders").select("o_orderkey", "o_totalprice"), order, 25)


# --- reshaping ----------------------------------------------------------------------------

_LONG = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(
    f"SELECT l_orderkey, l_partkey, '{c}' AS series, {c} AS value FROM lineitem" for c in _LONG))
def unpivot_series(spark, d):
    return reshape.to_long(s.table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"], _LONG, "series", "value")


@query("SELECT c_name AS name, 'customer' AS kind FROM customer UNION ALL SELECT s_name, 'supplier' FROM supplier")
def union_sources(spark, d):
    return reshape.union_sources(
        s.table(spark, d, "customer").select(F.col("c_name").alias("name"), F.lit("customer").alias("kind")),
        s.table(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name")))


@query("SELECT o_custkey, unnest(['Total', 'Open']) AS metric, unnest([count(*), count(*) FILTER "
       "(o_orderstatus = 'O')]) AS count FROM orders GROUP BY o_custkey")
def coverage_long(spark, d):
    wide = groups.group_stats(
        s.table(spark, d, "orders"), "o_custkey", total=F.count(F.lit(1)),
        open=numbers.count_where(F.col("o_orderstatus") == "O"))
    return reshape.coverage_long(wide, ["o_custkey"], [("total", "Total"), ("open", "Open")])
