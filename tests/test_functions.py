"""Column functions, with a row on each side of every boundary."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobtide.fixed_values import NOISE_PATTERNS
from jobtide.functions import dates, labels, numbers, salary, text
from jobtide.plans.facts import drop_non_skills


def values(spark, data, schema, column):
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


@pytest.mark.parametrize("observed, period, expected", [
    (250000.0, "HOURLY", "YEARLY"),
    (250000.0, "MONTHLY", "YEARLY"),
    (249999.0, "MONTHLY", "YEARLY"),
    (50000.0, "MONTHLY", "MONTHLY"),
    (50001.0, "MONTHLY", "YEARLY"),
    (15000.0, "MONTHLY", "MONTHLY"),
    (15000.0, "WEEKLY", "YEARLY"),
    (14999.0, "WEEKLY", "WEEKLY"),
    (14999.0, "BIWEEKLY", "BIWEEKLY"),
    (14999.0, "YEARLY", "MONTHLY"),
    (4000.0, "HOURLY", "MONTHLY"),
    (4000.0, None, "MONTHLY"),
    (3999.0, "HOURLY", "WEEKLY"),
    (3999.0, "BIWEEKLY", "BIWEEKLY"),
    (2500.0, "MONTHLY", "MONTHLY"),
    (2499.0, "MONTHLY", "WEEKLY"),
    (1000.0, "YEARLY", "WEEKLY"),
    (999.0, "YEARLY", "HOURLY"),
    (200.0, "WEEKLY", "WEEKLY"),
    (199.0, "WEEKLY", "HOURLY"),
    (None, "WEEKLY", "WEEKLY"),
    (None, None, None),
])
def test_correct_period(spark, observed, period, expected):
    got = values(spark, [(observed, period)], "o double, p string",
                 salary.correct_period(F.col("o"), F.col("p")))
    assert got == [expected]


def test_annualise_by_period(spark):
    data = [(10.0, p) for p in ("HOURLY", "WEEKLY", "BIWEEKLY", "MONTHLY", "YEARLY", "ONCE", None)]
    got = values(spark, data, "a double, p string", salary.annualise(F.col("a"), F.col("p")))
    assert got == [20800.0, 520.0, 260.0, 120.0, 10.0, None, None]


@pytest.mark.parametrize("low, mid, high, currency, expected", [
    (None, 50000.0, None, "USD", 50000.0),
    (20000.0, 50000.0, 90000.0, "USD", 50000.0),
    (20000.0, None, 40000.0, "usd", 30000.0),
    (20000.0, None, None, "USD", 20000.0),
    (None, None, 40000.0, "USD", 40000.0),
    (None, None, None, "USD", None),
    (None, 14999.0, None, "USD", None),
    (None, 15000.0, None, "USD", 15000.0),
    (None, 1000000.0, None, "USD", 1000000.0),
    (None, 1000001.0, None, "USD", None),
    (None, 50000.0, None, "EUR", None),
    (None, 50000.0, None, None, None),
])
def test_salary_estimate(spark, low, mid, high, currency, expected):
    got = values(
        spark, [(low, mid, high, currency)], "l double, m double, h double, c string",
        salary.salary_estimate(F.col("l"), F.col("m"), F.col("h"), F.lit("YEARLY"), F.col("c")))
    assert got == [expected]


def test_remote_flag_is_a_fallback_chain(spark):
    data = [(None, "remote x"), ("full-time", "remote x"), ("Remote", None), (None, None), (None, "x")]
    got = values(spark, data, "w string, t string",
                 labels.remote_flag(F.col("w"), F.col("t"), default=False))
    assert got == [True, False, True, False, False]
    open_ended = values(spark, data, "w string, t string", labels.remote_flag(F.col("w")))
    assert open_ended == [None, False, True, None, None]


SKILLS = {
    "a": False, "": False, "go": True, "x" * 50: True, "x" * 51: False,
    "stakeholder management": False,  # the anchored pattern takes every 'stakeholder …'
    "a stakeholder z": True, "stakeholder": False, "shareholder track": False,
    "managed care": False, "cryptography": False, "401(k)": False, "401k plan": False, "18+": False,
    "u.s. citizen": False, "uxs. citizen": True, "eligible\nto work": False, "can do attributes": False,
    "strong sql and python": False, "strongly typed": True, "Driver's LICENSE": False,
    "certified nurse": False, "certified": True, "python": True, None: False,
}


def test_noise_filter(spark):
    df = spark.createDataFrame([(s,) for s in SKILLS], "skill_name string")
    kept = {r[0] for r in drop_non_skills(df).collect()}
    assert kept == {s for s, keep in SKILLS.items() if keep}


def test_like_regex_equals_ilike(spark):
    """Every pattern against pieces of every pattern: same verdict as a chain of ILIKEs."""
    pieces = [p.strip("%").replace("%", joint) for p in NOISE_PATTERNS for joint in ("", " and\n")]
    names = [n for p in pieces for n in (p, p[:-1], p[1:], "Z" + p.upper(), p + "!")]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    chain = F.lit(False)
    for pattern in NOISE_PATTERNS:
        chain = chain | F.col("n").ilike(pattern)
    wrong = df.select("n", text.ilike_any(F.col("n"), NOISE_PATTERNS).alias("a"), chain.alias("b"))
    assert wrong.where("a <> b").collect() == []


def test_like_regex_anchors(spark):
    def hits(pattern, names):
        return values(spark, [(n,) for n in names], "n string", text.ilike_any(F.col("n"), [pattern]))

    assert hits("ab%", ["abc", "xab"]) == [True, False]
    assert hits("%ab", ["xab", "ab\n", "abc"]) == [True, False, False]
    assert hits("ab", ["ab", "abx"]) == [True, False]
    assert hits("%", ["", "x"]) == [True, True]


def test_text_pieces(spark):
    data = [("Austin, Texas",), ("US",), (None,), ('"Austin", x',)]
    assert values(spark, data, "p string", text.place_part(F.col("p"), 0)) == ["Austin", "US", None, "Austin"]
    assert values(spark, data, "p string", text.place_part(F.col("p"), 1)) == ["Texas", None, None, "x"]
    assert values(spark, [("Y",), ("N",), ("y",), (None,)], "f string", text.yes_no(F.col("f"))) == [
        True, False, None, None]
    assert values(spark, [(" ",), ("x",), (None,)], "f string", text.not_blank(F.col("f"))) == [
        False, True, False]


@pytest.mark.parametrize("period, expected", [
    ("M01", dt.date(2024, 1, 1)), ("M12", dt.date(2024, 12, 1)), ("M13", None), ("S01", None),
    ("Q05", None), ("A01", None), (None, None), ("M00", None),
])
def test_period_date(spark, period, expected):
    got = values(spark, [("2024", period)], "y string, p string",
                 dates.period_date(F.col("y"), F.col("p")))
    assert got == [expected]


def test_safe_date(spark):
    data = [("2024-01-15",), (" 2024-1-5 ",), ("2024-01-15T00:00:00.000",), ("2024",), ("soon",),
            ("2024-02-30",), ("",), (None,)]
    assert values(spark, data, "d string", dates.safe_date(F.col("d"))) == [
        dt.date(2024, 1, 15), dt.date(2024, 1, 5), dt.date(2024, 1, 15), None, None, None, None, None]


def test_dates_do_not_depend_on_the_session_zone(spark):
    data = [(1711317014000.0, dt.datetime(2024, 3, 31, 23, 30))]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        row = spark.createDataFrame(data, "ms double, ts timestamp_ntz").select(
            dates.from_epoch_ms(F.col("ms")), dates.month_start(F.col("ts"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (dt.datetime(2024, 3, 24, 21, 50, 14), dt.datetime(2024, 3, 1))


def test_epoch_zero_is_unknown(spark):
    got = values(spark, [(0.0,), (-5.0,), (None,), (1000.0,)], "m double", dates.from_epoch_ms(F.col("m")))
    assert got == [None, None, None, dt.datetime(1970, 1, 1, 0, 0, 1)]


def test_calendar_columns(spark):
    saturday = [(dt.date(2024, 3, 2),)]
    row = spark.createDataFrame(saturday, "d date").select(
        dates.iso_weekday(F.col("d")), dates.is_weekend(F.col("d")), dates.date_key(F.col("d")),
        dates.month_name(F.col("d"))).first()
    assert tuple(row) == (6, True, 20240302, "March")


def test_ratios_and_casts(spark):
    data = [(1, 3), (1, 0), (None, 3)]
    ratio = numbers.safe_ratio(F.col("a"), F.col("b"), 4)
    assert values(spark, data, "a int, b int", ratio) == [0.3333, None, None]
    assert values(spark, [("1.5",), ("x",), ("",)], "s string", numbers.safe_cast(F.col("s"), "double")) == [
        1.5, None, None]
    assert values(spark, [("133780",), ("50.6",), ("-",)], "s string", numbers.safe_cast(F.col("s"), "int")) == [
        133780, 51, None]
    assert values(spark, [(2.5,), (-2.5,), (0.4,)], "s double", numbers.rounded_int(F.col("s"))) == [3, -3, 0]


def test_trending_needs_volume_and_growth(spark):
    data = [(11, 10), (12, 10), (9, 1), (12, None), (12, 0), (10, 9)]
    got = values(spark, data, "n long, b long", labels.is_trending(F.col("n"), F.col("b")))
    assert got == [False, True, False, False, False, True]
