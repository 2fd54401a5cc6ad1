"""Readers, writers and the incremental landing on small files."""

from __future__ import annotations

import csv
import io
import json
import os
import random

import pytest

from jobtide.plans import pipeline, refresh
from jobtide.sources import readers, writers
from jobtide.sources.catalog import BRONZE, SEED_BRONZE
from jobtide.streaming.landing import land_live_postings

POSTING = {
    "id": "1", "title": "Dev", "location": {"display_name": "Austin, Texas", "area": ["US"]},
    "company": {"display_name": "Acme"}, "category": {"label": "IT", "tag": "it"},
    "salary_min": 10, "created": "2026-03-01T00:00:00Z",
}


def write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as out:
        out.write(text)
    return str(path)


def test_flatten_list_of_objects(spark, tmp_path):
    path = write(f"{tmp_path}/a/x.json", json.dumps([POSTING, {"id": "2"}], indent=2))
    flat = readers.flatten_json(readers.read_json(spark, path, readers.LIVE_POSTING))
    rows = {r["id"]: r for r in flat.collect()}
    assert rows["1"]["location.display_name"] == "Austin, Texas"
    assert rows["1"]["category.label"] == "IT"
    assert rows["2"]["company.display_name"] is None
    inferred = readers.flatten_json(readers.read_json(spark, path))
    assert "location.area" in inferred.columns


def test_series_payload(spark, tmp_path):
    changes = {"net_changes": {"1": "0.1", "12": "0.2"}, "pct_changes": {"1": "2.5"}}
    payload = {"status": "ok", "Results": {"series": [
        {"seriesID": "A", "data": [{"year": "2024", "period": "M01", "value": "4", "calculations": changes},
                                   {"year": "2024", "period": "M02", "value": "5"}]},
        {"data": [{"year": "2023", "period": "M13", "value": "1"}]}, {"seriesID": "B", "data": []}]}}
    path = write(f"{tmp_path}/bls/p.json", json.dumps(payload, indent=2))
    rows = readers.explode_series(readers.read_json(spark, path, readers.LABOR_PAYLOAD))
    got = {(r["seriesID"], r["period"]): r for r in rows.collect()}
    assert set(got) == {("A", "M01"), ("A", "M02"), ("unknown", "M13")}
    assert got["A", "M01"]["calculations.net_changes.12"] == "0.2"
    assert got["A", "M02"]["calculations.pct_changes.1"] is None


def test_map_payload(spark, tmp_path):
    payload = {"series_ids": ["U", "D"], "data": {
        "2024-01-01": {"U": 3.5, "D": None}, "2024-01-02": {"D": 5}}}
    path = write(f"{tmp_path}/fred/p.json", json.dumps(payload, indent=2))
    rows = readers.wide_from_map(readers.read_payloads(spark, path), ["U", "D", "X"])
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("2024-01-01", 3.5, None, None), ("2024-01-02", None, 5.0, None)]


def test_header_row_payload(spark, tmp_path):
    payload = [["NAME", "V", "metro"], ["Austin", "1", "12420"], ["Else", "2", "99999"], ["Null", None, "41860"]]
    path = write(f"{tmp_path}/acs/p.json", json.dumps(payload))
    rows = readers.header_rows(
        readers.read_payloads(spark, path), ["metro", "V", "missing"], keep=readers.METRO_CODES)
    assert sorted(tuple(r) for r in rows.collect()) == [("12420", "1", None), ("41860", None, None)]


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_rejects(spark, tmp_path, multi_line):
    text = b'id,name,city\n1,"a, ""b""",x\n2,short\n3,long,x,y\n4,nul\x00l,z\n5,\xff,w\n'
    if multi_line:
        text += b'6,"two\nlines",v\n'
    path = f"{tmp_path}/c.csv"
    with open(path, "wb") as out:
        out.write(text)
    good, bad = readers.read_csv_clean(spark, path, ["id", "name", "city"], multi_line)
    rows = {r["id"]: r["name"] for r in good.collect()}
    expected = {"1": 'a, "b"', "4": "null", "5": "�"}
    if multi_line:
        expected["6"] = "two\nlines"
    assert rows == expected
    assert good.count() == len(expected) and bad.count() == 2
    assert sorted(r[0].strip() for r in bad.collect()) == ["2,short", "3,long,x,y"]


def test_csv_to_parquet(spark, tmp_path):
    write(f"{tmp_path}/in/jobs/linkedin_salaries.csv",
          "salary_id,job_id,max_salary,med_salary,min_salary,pay_period,currency,extra\n1,2,30.5,,,HOURLY,USD,e\n")
    write(f"{tmp_path}/in/empty.csv", "a,b\n")
    write(f"{tmp_path}/in/skipped.csv", "a\n1\n")
    written = readers.csv_to_parquet(
        spark, f"{tmp_path}/in", f"{tmp_path}/out", skip=["skipped.csv"], schemas=readers.file_schemas())
    assert written == {"jobs/linkedin_salaries.parquet": (1, 0)}
    written = list(written)
    table = spark.read.parquet(f"{tmp_path}/out/{written[0]}")
    assert tuple(table.first()) == (1, 2, 30.5, None, None, "HOURLY", "USD", "e")
    assert "snappy" in os.listdir(f"{tmp_path}/out/{written[0]}")[-1] + "".join(
        os.listdir(f"{tmp_path}/out/{written[0]}"))


def test_csv_to_parquet_rejects_broken_rows(spark, tmp_path):
    write(f"{tmp_path}/in/a b/broken.csv", "c,b,a\n1,short\n1,2,3\n1,2,3,4\n5,n\x00l,6\n")
    write(f"{tmp_path}/in/lines.csv", 'x,y\n1,"two\nlines"\n2\n')
    written = readers.csv_to_parquet(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert written == {"a b/broken.parquet": (2, 2), "lines.parquet": (1, 1)}
    table = spark.read.parquet(f"{tmp_path}/out/a b/broken.parquet")
    assert table.columns == ["c", "b", "a"]
    assert sorted(tuple(r) for r in table.collect()) == [("1", "2", "3"), ("5", "nl", "6")]
    rejects = spark.read.parquet(f"{tmp_path}/out/_rejects/a b/broken.parquet")
    assert sorted(r[0] for r in rejects.collect()) == ["1,2,3,4", "1,short"]
    assert spark.read.parquet(f"{tmp_path}/out/lines.parquet").first()["y"] == "two\nlines"


@pytest.fixture
def small_splits(spark):
    """Files are cut every few bytes, so that bounds lie in quotes, line breaks and headers."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {n: spark.conf.get(n, None) for n in names}
    for n, value in zip(names, ("37", "0", "1")):
        spark.conf.set(n, value)
    yield
    for n, value in old.items():
        spark.conf.set(n, value) if value is not None else spark.conf.unset(n)


def random_csv(seed: int) -> str:
    draw = random.Random(seed)
    fields = ["", "plain", "two\nlines", 'say "yes"', '"', '""', "a,b", "\n", "é\n\n😀", 'x"\n"y', "tail\n", ",", '",\n"', "long " * 12]
    out = io.StringIO()
    write = csv.writer(out, quoting=draw.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), lineterminator=draw.choice(["\n", "\r\n"]))
    write.writerow(["id", "first name", "b\nc"])
    for i in range(40):
        row = [str(i), draw.choice(fields), draw.choice(fields)]
        write.writerow(row[:2] if i % 11 == 5 else [*row, "more"] if i % 13 == 7 else row)
    return out.getvalue()


@pytest.mark.parametrize("seed", range(4))
def test_records_over_many_splits(spark, tmp_path, small_splits, seed):
    text = random_csv(seed)
    path = f"{tmp_path}/c.csv"
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write(text)
    rows = list(csv.reader(io.StringIO(text.replace("\r\n", "\n"))))
    lines = readers._lines(spark, path, "*")
    assert lines.select("split").distinct().count() > 10
    assert readers.spans_lines(spark, path)
    records = [r.record for r in readers.csv_records(lines).orderBy("split", "at").collect()]
    assert [next(csv.reader(io.StringIO(r, newline=""))) for r in records] == rows
    written = readers.csv_to_parquet(spark, str(tmp_path), f"{tmp_path}/out")
    good = [r for r in rows[1:] if len(r) == 3]
    assert written == {"c.parquet": (len(good), len(rows) - 1 - len(good))}
    table = spark.read.parquet(f"{tmp_path}/out/c.parquet")
    assert table.columns == ["id", "first name", "b\nc"]
    got = sorted(tuple(v or "" for v in r) for r in table.collect())
    assert [g[0] for g in got] == sorted(r[0] for r in good)
    assert got == sorted(map(tuple, good))


def test_stray_quotes_leave_no_field_open(spark, tmp_path):
    path = write(f"{tmp_path}/c.csv", 'id,size\n1,5" x\n2,"a\nb" c\n3,x "y\n4,""\n')
    good, bad = readers.read_csv_clean(spark, path, multi_line=True)
    assert good.count() == 4 and bad.count() == 0
    assert not readers.spans_lines(spark, write(f"{tmp_path}/d.csv", 'id,size\n1,5" x\n3,x "y\n'))


def test_jobs_of_a_conversion_do_not_chain(spark, tmp_path):
    """One look at the folder and one cut of records, then a job per table."""
    for folder, files in (("few", 2), ("many", 9)):
        for i in range(files):
            write(f"{tmp_path}/{folder}/t{i}.csv", 'x,y\n1,"two\nlines"\n' if i % 2 else "x,y\n1,2\n")
    jobs = {}
    tracker = spark.sparkContext.statusTracker()
    for folder, files in (("few", 2), ("many", 9)):
        before = len(tracker.getJobIdsForGroup())
        assert len(readers.csv_to_parquet(spark, f"{tmp_path}/{folder}", f"{tmp_path}/out/{folder}")) == files
        jobs[folder] = len(tracker.getJobIdsForGroup()) - before
    assert jobs["many"] - jobs["few"] <= 9 - 2


def test_csv_names_come_from_the_header(spark, tmp_path):
    path = write(f"{tmp_path}/c.csv", "c,b,a\n1,2,3\n")
    good, _ = readers.read_csv_clean(spark, path, ["a", "b"])
    assert good.columns == ["a", "b"] and tuple(good.first()) == ("3", "2")


def test_line_breaks_decide_about_splitting(spark, tmp_path):
    plain = write(f"{tmp_path}/a.csv", 'id,name\n1,"x ""y"""\n')
    broken = write(f"{tmp_path}/b.csv", 'id,name\n1,"x\ny"\n')
    assert not readers.spans_lines(spark, plain)
    assert readers.spans_lines(spark, broken)
    good, _ = readers.read_csv_clean(spark, broken, ["id", "name"])
    assert good.first()["name"] == "x\ny"


def test_landing_fills_the_raw_layout(spark, tmp_path):
    api, raw = f"{tmp_path}/api", f"{tmp_path}/raw"
    write(f"{api}/adzuna/adzuna_x_all_20260301.json", json.dumps([POSTING]))
    write(f"{api}/bls/bls_2023_2026.json", json.dumps({"Results": {"series": [
        {"seriesID": "A", "data": [{"year": "2024", "period": "M01", "value": "4"}]}]}}))
    write(f"{api}/fred/fred_series.json", json.dumps({"series_ids": ["DFF"], "data": {"2024-01-01": {"DFF": 5}}}))
    write(f"{api}/acs/acs.json", json.dumps([["NAME", "DP03_0062E", readers.METRO_KEY],
                                             ["Austin", "90000", "12420"], ["Else", "1", "99999"]]))
    write(f"{tmp_path}/onet/Job Zones.txt", "O*NET-SOC Code\tTitle\tJob Zone\n15-1252.00\tDev\t4\n")
    write(f"{tmp_path}/onet/Unused.txt", "x\n")
    write(f"{tmp_path}/csv/kaggle/linkedin_jobs/mappings/linkedin_mapping_skills.csv", "skill_abr,skill_name\nIT,Tech\n")
    pipeline.land(spark, raw, api, f"{tmp_path}/onet", f"{tmp_path}/csv")
    names = ["stg_adzuna__postings", "stg_bls__series", "stg_fred__series", "stg_acs__metro_profiles",
             "stg_onet__job_zones", "stg_kaggle_linkedin__mapping_skills"]
    tables = readers.bronze(spark, raw, names)
    assert {n: df.count() for n, df in tables.items()} == dict.fromkeys(names, 1)
    assert tables["stg_adzuna__postings"].first()["location.display_name"] == "Austin, Texas"
    assert tables["stg_fred__series"].first()["DFF"] == 5.0
    assert tables["stg_onet__job_zones"].first()["Job Zone"] == 4
    assert tables["stg_acs__metro_profiles"].first()["DP03_0062E"] == "90000"


def test_tsv(spark, tmp_path):
    path = write(f"{tmp_path}/t.txt", "Code\tTitle\n1\ta, b\n")
    assert [tuple(r) for r in readers.read_tsv(spark, path).collect()] == [("1", "a, b")]


def test_wildcard_scan_merges_schemas(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/src/f_1.parquet")
    spark.range(2).selectExpr("id", "'x' AS extra").write.parquet(f"{tmp_path}/src/f_2.parquet")
    merged = readers.read_raw(spark, str(tmp_path), "src", "f_*.parquet")
    assert merged.columns == ["id", "extra"] and merged.count() == 4


def test_catalog_has_all_bronze_tables():
    assert len(BRONZE) + len(SEED_BRONZE) == 32


def test_batches(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "id string, n int")
    tagged = readers.tag_batch(df, "data engineer", "", "2026-03-01")
    assert tagged.first()["_search_location"] == "all"
    assert readers.dedup_batch(tagged, order=["n"]).count() == 3


def test_save_returns_a_scan(spark, tmp_path):
    df = spark.range(10).selectExpr("id % 2 AS k", "id")
    saved = writers.save(df, str(tmp_path), "silver", "t", ["k"])
    assert saved.columns == ["k", "id"] and saved.where("k = 1").count() == 5
    assert spark.read.parquet(f"{tmp_path}/silver/t").count() == 10


def test_landing_takes_each_file_once(spark, tmp_path):
    inbox, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck"
    write(f"{inbox}/adzuna_1.json", json.dumps([POSTING]))
    land_live_postings(spark, inbox, out, checkpoint)
    write(f"{inbox}/adzuna_2.json", json.dumps([{"id": "2"}, POSTING]))
    land_live_postings(spark, inbox, out, checkpoint)
    land_live_postings(spark, inbox, out, checkpoint)
    landed = spark.read.parquet(f"{out}/batch-*")
    assert sorted(r["id"] for r in landed.collect()) == ["1", "1", "2"]
    assert "location.display_name" in landed.columns


def test_landing_keeps_fields_that_nobody_listed(spark, tmp_path):
    inbox, out, latest = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/latest"
    write(f"{inbox}/adzuna_1.json", json.dumps([POSTING, {"id": 7, "salary_min": "x"}]))
    land_live_postings(spark, inbox, out, f"{tmp_path}/ck", latest=latest)
    write(f"{inbox}/adzuna_2.json", json.dumps([
        {**POSTING, "created": "2026-03-02T00:00:00Z", "title": "newer", "ad ref": 5, "more": {"deep": {"er": True}}}, {"title": "no id"}]))
    write(f"{inbox}/adzuna_3.json", '[1, {"id": "2"}]')
    write(f"{inbox}/adzuna_4.json", json.dumps({"id": "4", "location": {"area": ["US", "TX"]}}))
    land_live_postings(spark, inbox, out, f"{tmp_path}/ck", latest=latest)
    first, second = spark.read.parquet(f"{out}/batch-000000"), spark.read.parquet(f"{out}/batch-000001")
    assert {"location.area", "category.tag"} <= set(first.columns) and first.count() == 2
    rows = {r["id"]: r for r in second.collect()}
    assert set(rows) == {"1", "4", None}
    assert (rows["1"]["ad ref"], rows["1"]["more.deep.er"]) == ("5", "true")
    assert json.loads(rows["4"]["location.area"]) == ["US", "TX"]
    kept = {r["id"]: r for r in refresh.merged_rows(spark, latest).collect()}
    assert set(kept) == {"1", "7", "4", None} and kept["1"]["title"] == "newer"
    assert kept["7"]["salary_min"] is None and dict(second.dtypes)["salary_min"] == "double"
    assert [r["text"] for r in spark.read.parquet(f"{out}/rejects/batch-*").collect()] == ['[1, {"id": "2"}]']


def test_found_fields(spark):
    texts = ['{"a": 1}', '{"a": 2.5, "b": {"c": "x"}}', "no json", '{"b": {"d": [1, 2]}, "a": null}', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, body string")
    flat = readers.flatten_found(df, "body")
    assert set(flat.columns) == {"id", "a", "b.c", "b.d"}
    rows = {r["id"]: (None if r["a"] is None else float(r["a"]), r["b.c"], r["b.d"]) for r in flat.collect()}
    assert rows == {0: (1.0, None, None), 1: (2.5, "x", None), 2: (None,) * 3, 3: (None, None, [1, 2]), 4: (None,) * 3}
    lists = spark.createDataFrame([('[{"a": 1}, {"b": "x"}]',), ("[]",)], "body string")
    assert sorted(map(str, readers.flatten_found(lists, "body").collect())) == ["Row(a=1, b=None)", "Row(a=None, b='x')"]
    assert readers.flatten_found(df.where("id = 2"), "body").columns == ["id"]


def test_landing_rejects_damaged_files_and_leaves_no_strays(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    inbox, out, checkpoint = f"{tmp_path}/in", f"{raw}/adzuna/live", f"{tmp_path}/ck"
    write(f"{inbox}/adzuna_data_engineer_austin_20260301.json", '[{"id": "1", "title"')
    write(f"{inbox}/adzuna_dev_ops_all_20260302.json", json.dumps([
        POSTING, {**POSTING, "title": "later"}, {**POSTING, "id": None}, {"title": "no id"},
        {"id": "3", "_search_query": "given", "_search_location": "here", "_fetched_at": "2026-03-02T00:00:00"}]))
    land_live_postings(spark, inbox, out, checkpoint)
    spark.createDataFrame([("stray",)], "id string").write.parquet(f"{tmp_path}/stray")
    stray = next(f for f in os.listdir(f"{tmp_path}/stray") if f.endswith(".parquet"))
    with open(f"{tmp_path}/stray/{stray}", "rb") as part, open(f"{out}/{stray}", "wb") as copy:
        copy.write(part.read())
    rows = readers.bronze(spark, raw, ["stg_adzuna__postings"])["stg_adzuna__postings"].collect()
    assert sorted((r["id"] or "", r["title"] or "") for r in rows) == [("", "Dev"), ("", "no id"), ("1", "Dev"), ("3", "")]
    marks = {r["id"]: (r["_search_query"], r["_search_location"]) for r in rows}
    assert marks["1"] == ("dev ops", "all") and marks["3"] == ("given", "here")
    assert all(r["_fetched_at"] for r in rows)
    rejects = spark.read.parquet(f"{out}/rejects/batch-*").collect()
    assert [r["text"] for r in rejects] == ['[{"id": "1", "title"'] and "austin" in rejects[0]["file"]
