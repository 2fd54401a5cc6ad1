"""Raw feeds to flat tables.

JSON payloads that span lines cannot be split inside a file, so there the file is the unit of
parallel work; feeds land as many files of a few megabytes. CSV, TSV and Parquet is read in
splits, CSV also where quoted fields hold line breaks.
"""

from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.fixed_values import METRO_BRIDGE, METRO_KEY, METRO_VARIABLES, SKILL_VARIANTS
from jobtide.operators.joins import inline_mapping
from jobtide.operators.reshape import dedup_keep_null
from jobtide.operators.windows import earliest_first
from jobtide.session import shared_folder
from jobtide.sources.catalog import BRONZE, SEED_BRONZE, SEEDS, columns

# --- parquet ------------------------------------------------------------------------------


def read_raw(spark: SparkSession, root: str, source: str, file: str,
             schema: T.StructType | None = None) -> DataFrame:
    """Parquet file or wildcard of one source.

    With a schema no footer is read before the scan and columns a file lacks are NULL; without
    one the schemas of all files are merged.
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    return reader.parquet(f"{root}/{source}/{file}")


def bronze(spark: SparkSession, root: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Lazy scans of the bronze tables (all of them unless named)."""
    wanted = names or [*BRONZE, *SEED_BRONZE]
    tables = {}
    for name in wanted:
        if name in SEED_BRONZE:
            tables[name] = read_seed(spark, f"{root}/seeds", SEED_BRONZE[name])
        else:
            entry = BRONZE[name]
            tables[name] = read_raw(spark, root, entry.source, entry.file, entry.schema)
    return tables


# --- seeds --------------------------------------------------------------------------------


def read_seed(spark: SparkSession, folder: str, name: str, sep: str | None = None) -> DataFrame:
    """Seed CSV with a header, all columns text, delimiter by table."""
    file, usual_sep, used = SEEDS[name]
    table = spark.read.csv(f"{folder}/{file}", header=True, sep=sep or usual_sep, quote='"', escape='"')
    return table.select(*[F.col(f"`{c}`") for c in used])


def built_in_seeds(spark: SparkSession) -> dict[str, DataFrame]:
    """The two reference tables that come with the engine."""
    return {
        "state_to_cbsa_bridge": inline_mapping(spark, METRO_BRIDGE, ["state", "city", "cbsa_fips"]),
        "skill_name_normalization": inline_mapping(
            spark, SKILL_VARIANTS, ["raw_skill", "canonical_skill"]),
    }


# --- JSON ---------------------------------------------------------------------------------

LIVE_POSTING = (
    "id string, title string, description string, contract_time string, salary_min double, "
    "salary_max double, latitude double, longitude double, location struct<display_name: string>, "
    "company struct<display_name: string>, category struct<label: string>, created string, "
    "_search_query string, _search_location string, _fetched_at string"
)

# The same fields by the column they become.
LIVE_FIELDS = {
    **dict.fromkeys(["id", "title", "description", "contract_time"], "string"),
    **dict.fromkeys(["salary_min", "salary_max", "latitude", "longitude"], "double"),
    **dict.fromkeys(["location.display_name", "company.display_name", "category.label", "created", "_search_query",
                     "_search_location", "_fetched_at"], "string"),
}

_CHANGES = "struct<`1`: string, `3`: string, `6`: string, `12`: string>"
LABOR_PAYLOAD = (
    "Results struct<series: array<struct<seriesID: string, data: array<struct<year: string, "
    "period: string, periodName: string, value: string, latest: string, "
    f"calculations: struct<net_changes: {_CHANGES}, pct_changes: {_CHANGES}>>>>>>"
)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Whole-file JSON; a top-level list gives a row per element."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path, multiLine=True)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its text in ``value``."""
    return spark.read.text(path, wholetext=True)


def _leaves(schema: T.StructType, path: str, label: str, sep: str) -> list[Column]:
    found = []
    for field in schema.fields:
        here = f"{path}.`{field.name}`" if path else f"`{field.name}`"
        name = f"{label}{sep}{field.name}" if label else field.name
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, here, name, sep)
        else:
            found.append(F.col(here).alias(name))
    return found


def flatten_json(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested objects as columns named by their path; arrays stay arrays."""
    return df.select(*_leaves(df.schema, "", "", sep))


def found_type(df: DataFrame, json: str) -> str:
    """The type that fits the JSON texts of a column, found from all of them in one aggregate; '' without any object.

    Fields come and go between rows and nobody lists them. Numbers of several kinds become the widest, values that
    have no common type text.
    """
    merged = df.agg(F.schema_of_variant_agg(F.try_parse_json(json))).first()[0] or ""
    if not re.search(r"OBJECT<.", merged):
        return ""
    return re.sub(r"(?<![`\w])(OBJECT|VARIANT|VOID)\b(?!`)", lambda m: {"OBJECT": "STRUCT"}.get(m[1], "STRING"), merged)


def flatten_found(df: DataFrame, json: str, sep: str = ".") -> DataFrame:
    """Rows whose ``json`` text is an object, or a list of them, with a column for every field found in any row.

    Columns are named by their path, arrays stay arrays, a field that a row lacks is NULL. Other columns stay; text
    that is no JSON gives a row without fields, an empty list none. A list gives a row per element.
    """
    kind = found_type(df, json)
    rest = [c for c in df.columns if c != json]
    if not kind:
        return df.select(*rest)
    parsed = F.try_variant_get(F.try_parse_json(json), "$", kind)
    if kind.startswith("ARRAY"):
        return flatten_json(df.select(*rest, F.explode(parsed).alias("__o")).select(*rest, "__o.*"), sep)
    return flatten_json(df.select(*rest, parsed.alias("__o")).select(*rest, "__o.*"), sep)


def explode_series(df: DataFrame) -> DataFrame:
    """Payloads with ``Results.series[].data[]`` to a row per observation."""
    series = df.select(F.explode("Results.series").alias("s"))
    rows = series.select(
        F.coalesce("s.seriesID", F.lit("unknown")).alias("seriesID"), F.explode("s.data").alias("obs")
    )
    return flatten_json(rows.select("obs.*", "seriesID"))


def wide_from_map(df: DataFrame, series: Sequence[str], text: str = "value") -> DataFrame:
    """Payloads ``{data: {date: {series: number}}}`` to a row per date, a column per series."""
    data = F.from_json(F.get_json_object(text, "$.data"), "map<string, map<string, double>>")
    days = df.select(F.explode(data).alias("date", "values"))
    return days.select("date", *[F.col("values").getItem(s).alias(s) for s in series])


def header_rows(df: DataFrame, names: Sequence[str], keep: Sequence[str] | None = None,
                text: str = "value") -> DataFrame:
    """Payloads that are a list of lists with the header first, to named rows.

    ``keep`` lists the accepted values of the last column.
    """
    table = F.from_json(text, "array<array<string>>")
    parsed = df.select(table.alias("t")).select(
        F.get("t", F.lit(0)).alias("header"), F.posexplode("t").alias("pos", "row")
    ).where("pos > 0")
    if keep is not None:
        parsed = parsed.where(F.element_at("row", -1).isin(*keep))
    return parsed.select(*[
        F.get("row", (F.array_position("header", n) - 1).cast("int")).alias(n) for n in names
    ])


METRO_NAMES = ["NAME", *[code for code, _, _ in METRO_VARIABLES], METRO_KEY]
METRO_CODES = [code for _, _, code in METRO_BRIDGE]

# --- CSV and TSV --------------------------------------------------------------------------


def plain_path(path: str) -> str:
    """A path as the file system names it: no escapes, and none of the spellings of file:/."""
    return re.sub(r"^file:/+", "/", unquote(path))


# A quoted field without its closing quote, and a line that leaves one open, read from outside quotes.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_OPENS = rf'(?:(?:{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+{_QUOTED}\z'
# The same, read from inside quotes.
_STAYS = rf'[^"]*+(?:""[^"]*+)*+(?:\z|"[^,]*+,{_OPENS})'


def _opens(line: Column) -> Column:
    return line.contains('"') & line.rlike(rf"\A{_OPENS}")


def _stays(line: Column) -> Column:
    return ~line.contains('"') | line.rlike(rf"\A{_STAYS}")


def _lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(file, split, id, line) of text files; id orders the lines of a split."""
    found = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(path)
    return found.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), F.make_valid_utf8("value").alias("line"))


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether some quoted field of a CSV, or of one in a folder, holds a line break. Reads in splits."""
    return not _lines(spark, path, "*").where(_opens(F.col("line"))).isEmpty()


def csv_files(spark: SparkSession, folder: str, pattern: str) -> list[Row]:
    """(file, header, lines, spans) of every file below a folder in one job: first line, lines, line breaks in quotes."""
    lines = _lines(spark, folder, pattern).where(F.trim("line") != "")
    return lines.groupBy("file").agg(
        F.min_by("line", F.struct("split", "id")).alias("header"), F.count("*").alias("lines"),
        F.bool_or(_opens(F.col("line"))).alias("spans")).collect()


def csv_records(lines: DataFrame) -> DataFrame:
    """Lines (file, split, id, line) to records (file, split, at, record) with their line breaks.

    Whether a line begins inside quotes depends on all lines before it. A line keeps the state, turns it round or sets
    it, so a split of a file is one such step too: each split is read for both states it may begin in, the few rows of
    all splits tell which it is, and a record that began in an earlier split is put together by where it began. A file
    of any size is as many tasks as it has splits. Lines that are no part of a longer record are not grouped.
    """
    inside, in_file = ["file", "split"], Window.partitionBy("file").orderBy("split")
    upto = Window.partitionBy(*inside).orderBy("id")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    opens, stays = _opens(F.col("line")), _stays(F.col("line"))
    # state behind = last set value, or the state at the beginning, turned round as often as lines did so since
    turns = lines.withColumns({"at": F.row_number().over(upto), "opens": opens, "stays": stays}).withColumn(
        "turned", F.coalesce(F.sum(F.expr("int(opens AND NOT stays)")).over(before), F.lit(0)) % 2)
    fixed = F.expr("CASE WHEN opens = stays THEN int(opens) ^ turned END")
    known = turns.withColumn("fixed", F.last(fixed, ignorenulls=True).over(before))
    state = lambda begin: F.coalesce("fixed", F.lit(begin)).bitwiseXOR(F.col("turned"))
    ends = lambda begin: F.when(state(begin) == 1, F.col("stays")).otherwise(F.col("opens"))
    starts = lambda begin: F.max(F.when(state(begin) == 0, F.col("at")))
    splits = known.groupBy(*inside).agg(
        F.max_by(ends(0), "at").alias("end0"), F.max_by(ends(1), "at").alias("end1"),
        starts(0).alias("start0"), starts(1).alias("start1"))
    # The same step from split to split.
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("turned", F.coalesce(F.sum(F.expr("int(end0 AND NOT end1)")).over(earlier), F.lit(0)) % 2)
    splits = splits.withColumn("fixed", F.last(
        F.expr("CASE WHEN end0 = end1 THEN int(end0) ^ turned END"), ignorenulls=True).over(earlier))
    splits = splits.withColumn("begin", state(0))
    last = F.when(F.expr("if(begin = 1, start1, start0) IS NOT NULL"), F.expr("struct(split, if(begin = 1, start1, start0) AS at)"))
    splits = splits.select(*inside, "begin", F.last(last, ignorenulls=True).over(earlier).alias("carried"))

    placed = known.join(splits, inside).withColumn("state", F.coalesce("fixed", "begin").bitwiseXOR(F.col("turned")))
    begun = F.last(F.when(F.col("state") == 0, F.struct("split", "at")), ignorenulls=True).over(upto)
    placed = placed.withColumn("key", F.coalesce(begun, "carried"))
    alone = (F.col("state") == 0) & ~F.col("opens")
    single = placed.where(alone & (F.trim("line") != "")).select("file", "split", "at", F.col("line").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("split", "at", "line")))
    longer = placed.where(~alone).groupBy("file", "key").agg(parts.alias("parts")).select(
        "file", "key.split", "key.at", F.array_join(F.col("parts.line"), "\n").alias("record"))
    return single.unionByName(longer)


def header_names(header: str) -> list[str]:
    """The field names in a header record; empty and repeated ones get their place."""
    names = [name.replace("\u0000", "") for name in next(csv.reader([header]))]
    lower = [name.lower() for name in names]
    return [f"_c{i}" if not name else f"{name}{i}" if lower.count(name.lower()) > 1 else name for i, name in enumerate(names)]


def csv_names(spark: SparkSession, path: str) -> list[str]:
    """The field names in the header line of a CSV."""
    header = spark.read.csv(path, header=True, quote='"', escape='"').columns
    return [name.replace("\u0000", "") for name in header]


def _fields(raw: DataFrame, fields: Sequence[str], names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    # A scan that is pruned to some of the fields does not notice missing or surplus ones. The
    # split therefore looks at all of them, with a condition that always holds.
    touched = F.length(F.concat_ws("", *[f"`{n}`" for n in fields])) >= 0
    good = raw.where(F.col("_bad").isNull() & touched).select(
        *[F.regexp_replace(F.col(f"`{n}`"), "\u0000", "").alias(n) for n in names]
    )
    return good, raw.where(F.col("_bad").isNotNull() & touched).select("_bad")


def parse_records(records: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Records to their fields, all text, and ``_bad``, the record if it has too few or too many of them."""
    schema = columns(string=fields).add("_bad", T.StringType())
    parsed = F.from_csv("record", ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields),
                        {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return records.select(parsed.alias("r")).select("r.*")


def read_csv_clean(spark: SparkSession, path: str, names: Sequence[str] | None = None,
                   multi_line: bool | None = None, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected raw records) of a CSV, read in splits.

    Fields are named by the header, ``names`` picks some of them; without a header ``names`` are
    the fields in their order. Rows with too few or too many fields are rejected, NUL bytes
    removed, undecodable bytes replaced. ``multi_line`` tells whether quoted fields hold line
    breaks; unless given, the file decides. If they do, records are cut out first (:func:`csv_records`).
    """
    if multi_line is None:
        multi_line = spans_lines(spark, path)
    fields = csv_names(spark, path) if header else list(names or [])
    if multi_line:
        records = csv_records(_lines(spark, path, "*"))
        raw = parse_records(without_headers(records) if header else records, fields)
    else:
        raw = spark.read.csv(
            path, schema=columns(string=fields).add("_bad", T.StringType()), header=header, mode="PERMISSIVE",
            columnNameOfCorruptRecord="_bad", quote='"', escape='"')
    return _fields(raw, fields, names or fields)


def without_headers(records: DataFrame) -> DataFrame:
    """All but the first record of every file."""
    first = records.groupBy("file").agg(F.min(F.struct("split", "at")).alias("first"))
    return records.join(first, "file").where(F.struct("split", "at") != F.col("first"))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated file with a header, all columns text."""
    return spark.read.csv(path, header=True, sep="\t", quote='"', escape='"')


def typed(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """Cast the declared columns by name; others stay as they are."""
    if schema is None:
        return df
    casts = {
        f.name: F.col(f"`{f.name}`").try_cast(f.dataType)
        for f in schema.fields if f.name in df.columns and not isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(casts) if casts else df


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths below a folder. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option(
        "recursiveFileLookup", True).load(folder)
    return sorted(row.path for row in files.select("path").collect())


def csv_to_parquet(spark: SparkSession, folder: str, out: str, skip: Sequence[str] = (),
                   schemas: dict[str, T.StructType] | None = None,
                   side_by_side: int = 8) -> dict[str, tuple[int, int]]:
    """Every CSV below ``folder`` to snappy parquet at the same place below ``out``.

    Broken rows go to ``out/_rejects`` under the same name. Skipped: listed file names and files
    without any row. Returns (rows, rejected rows) by table written. One job looks at all files,
    one cuts out the records of all those with line breaks in quotes; then a table is one write,
    which counts its rows as it goes, and one more if it has rejects. A few tables are written at a time.
    """
    base = plain_path(folder).rstrip("/")
    stem = lambda path: plain_path(path)[plain_path(path).index(base) + len(base) + 1:].removesuffix(".csv")
    files = [f for f in csv_files(spark, folder, "*.csv") if plain_path(f.file).rsplit("/", 1)[-1] not in skip and f.lines > 1]
    spanning = sorted(f.file for f in files if f.spans)
    headers = {f.file: f.header for f in files if not f.spans}
    if spanning:
        numbers = F.create_map(*[F.lit(x) for i, file in enumerate(spanning) for x in (file, i)])
        lines = _lines(spark, folder, "*.csv").where(F.col("file").isin(spanning))
        cut = f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
        csv_records(lines).withColumn("number", numbers[F.col("file")]).write.partitionBy("number").parquet(cut)
        records = spark.read.schema("file string, split bigint, at int, record string, number int").parquet(cut)
        place = F.struct("split", "at")
        found = records.groupBy("file").agg(F.min_by("record", place).alias("header"), F.min(place).alias("first"), F.count("*").alias("n"))
        first = {r.file: r for r in found.where("n > 1").collect()}
        headers |= {file: r.header for file, r in first.items()}
        files = [f for f in files if f.file in headers]

    def convert(file: Row) -> tuple[str, tuple[int, int]] | None:
        name, fields = stem(file.file), header_names(headers[file.file])
        if file.spans:
            split, at = first[file.file].first
            body = records.where(F.col("number") == spanning.index(file.file)).where(f"NOT (split = {split} AND at = {at})")
            raw = parse_records(body, fields)
        else:
            raw = spark.read.csv(
                plain_path(file.file), schema=columns(string=fields).add("_bad", T.StringType()), header=True, mode="PERMISSIVE",
                columnNameOfCorruptRecord="_bad", quote='"', escape='"')
        counts = Observation()
        counted = raw.observe(counts, F.count(F.when(F.col("_bad").isNull(), 1)).alias("good"), F.count("_bad").alias("bad"))
        good, _ = _fields(counted, fields, fields)
        typed(good, (schemas or {}).get(name.rsplit("/", 1)[-1])).write.mode("overwrite").option(
            "compression", "snappy").parquet(f"{out}/{name}.parquet")
        found = counts.get
        if found["bad"]:
            _fields(raw, fields, fields)[1].write.mode("overwrite").parquet(f"{out}/_rejects/{name}.parquet")
        return f"{name}.parquet", (found["good"], found["bad"])

    with ThreadPoolExecutor(side_by_side) as pool:
        return dict(pool.map(convert, sorted(files, key=lambda f: f.file)))


def file_schemas() -> dict[str, T.StructType]:
    """Declared schemas by file stem, for :func:`csv_to_parquet`."""
    return {
        entry.file.removesuffix(".parquet"): entry.schema
        for entry in BRONZE.values() if entry.schema is not None
    }


# --- batches of fetched rows --------------------------------------------------------------


def tag_batch(df: DataFrame, query: str | Column, location: str | Column, fetched_at: str | Column,
              only_missing: bool = False) -> DataFrame:
    """Mark rows with the search they came from; an empty location means everywhere.

    ``only_missing`` keeps the marks that rows already have.
    """
    made = {
        "_search_query": query if isinstance(query, Column) else F.lit(query),
        "_search_location": location if isinstance(location, Column) else F.lit(location or "all"),
        "_fetched_at": fetched_at if isinstance(fetched_at, Column) else F.lit(fetched_at),
    }
    return df.withColumns({n: F.coalesce(F.col(n), c) if only_missing else c for n, c in made.items()})


def dedup_batch(df: DataFrame, key: str = "id", order: Sequence[str] = ("_fetched_at",),
                within: Sequence[str] = ()) -> DataFrame:
    """First row per id (in each of ``within``); rows without an id are all kept."""
    return dedup_keep_null(df, key, earliest_first(*order), within)
