import datetime as dt
import zoneinfo

import pytest
from pyspark.sql import functions as F

from folioforge.operators import timestamps as T


def utc(*a, **k):
    return int(dt.datetime(*a, **k, tzinfo=dt.UTC).timestamp() * 1_000_000)


CASES = [
    ("2023-02-28T14:05:43.245698Z", "dmy", "Europe/Berlin", utc(2023, 2, 28, 14, 5, 43, 245698)),
    ("20220726T212310,73+10", "dmy", "Europe/Berlin", utc(2022, 7, 26, 11, 23, 10, 730000)),
    ("20220222T144233,09+0100", "dmy", "UTC", utc(2022, 2, 22, 13, 42, 33, 90000)),
    ("1761436834588", "dmy", "Europe/Berlin", 1761436834588000),
    ("1630970656", None, None, 1630970656000000),
    ("20220506043041", "ymd", "Asia/Tokyo", utc(2022, 5, 5, 19, 30, 41)),
    ("07/04/2023 09:56:22", "dmy", "Europe/Paris", utc(2023, 4, 7, 7, 56, 22)),
    ("07/04/2023 09:56:22", "mdy", "America/New_York", utc(2023, 7, 4, 13, 56, 22)),
    ("22/06/05 21:12", "ymd", "Asia/Tokyo", utc(2022, 6, 5, 12, 12)),
    ("31.12.22 11:40", "dmy", "Europe/Berlin", utc(2022, 12, 31, 10, 40)),
    ("3. Februar 2023, 12:46 Uhr", "dmy", "Europe/Berlin", utc(2023, 2, 3, 11, 46)),
    ("24 février 2023 à 9h56", "dmy", "Europe/Paris", utc(2023, 2, 24, 8, 56)),
    ("令和5年9月14日 午後7時34分", "ymd", "Asia/Tokyo", utc(2023, 9, 14, 10, 34)),
    ("令和4年4月4日 午後0時28分", "ymd", "Asia/Tokyo", utc(2022, 4, 4, 3, 28)),
    ("２０２３／０１／０２　０２：５４：１５", "ymd", "Asia/Tokyo", utc(2023, 1, 1, 17, 54, 15)),
    ("12/8/2022 12:05:46 a.m.", "dmy", "Europe/Madrid", utc(2022, 8, 11, 22, 5, 46)),
    ("Wed, 21 Apr 2021 07:59:01 +0200", "dmy", "UTC", utc(2021, 4, 21, 5, 59, 1)),
    ("Sep 7, 2023 09:48:13", "mdy", "America/New_York", utc(2023, 9, 7, 13, 48, 13)),
    ("2023-10-29 02:30:00 CEST", "dmy", "Europe/Berlin", utc(2023, 10, 29, 0, 30)),
    ("2023-10-29 02:30:00 CET", "dmy", "Europe/Berlin", utc(2023, 10, 29, 1, 30)),
    ("2023-07-18 00:17:49 GMT-8", "dmy", "Europe/Berlin", utc(2023, 7, 18, 8, 17, 49)),
    ("2022-03-13 04:37[America/New_York]", "dmy", "Europe/Rome", utc(2022, 3, 13, 8, 37)),
    ("2022-01-13 04:37 America/Los_Angeles", "dmy", "Europe/Rome", utc(2022, 1, 13, 12, 37)),
    (" 2022-11-19T06:07:40+01:00\n", "dmy", "Europe/Rome", utc(2022, 11, 19, 5, 7, 40)),
    ("1850-06-01 12:00", "dmy", "Europe/Berlin", utc(1850, 6, 1, 11, 6, 32)),
    ("1791-06-01 12:00", "dmy", "Europe/Berlin", utc(1791, 6, 1, 11, 6, 32)),
    ("2450-07-01 12:00", "dmy", "Europe/Berlin", utc(2450, 7, 1, 10)),
    ("9999-12-31 23:00", "dmy", "America/New_York", utc(9999, 12, 31, 23) + 5 * 3600 * 1_000_000),
    ("2022-01-13 04:37 europe/berlin", "dmy", "UTC", utc(2022, 1, 13, 3, 37)),
    ("2022-01-13 04:37", "dmy", "europe/BERLIN", utc(2022, 1, 13, 3, 37)),
    ("2022-01-13 04:37 CST", "dmy", "Asia/Shanghai", utc(2022, 1, 12, 20, 37)),
    ("2022-01-13 04:37 CST", "dmy", "Europe/Berlin", utc(2022, 1, 13, 10, 37)),
    ("2022-01-13T24:00:00", "dmy", "UTC", utc(2022, 1, 14)),
    ("230970656", None, None, 230970656000000),
]
NONE = [
    ("2023-10-29 02:30:00", "Europe/Berlin", "ambiguous"), ("2023-03-26 02:30:00", "Europe/Berlin", "nonexistent"), ("2024-10-27T02:31:35[Europe/Amsterdam]", "Europe/Amsterdam", "ambiguous"),
    ("2024-02-30 10:11:12", "UTC", "impossible"), ("20231345T101112,00+01", "UTC", "impossible"), ("0000-00-00T00:00:00", "UTC", "impossible"), ("2023-09-29", "UTC", "unreadable"),
    ("20240607", "UTC", "unreadable"), ("n/a", "UTC", "unreadable"), ("", "UTC", "missing"), (None, "UTC", "missing"), ("2023-01-01 10:00", None, "no_zone"), ("2023-01-01 10:00", "Europe/Nowhere", "no_zone"), ("2450-03-27 02:30", "Europe/Berlin", "nonexistent"), ("2450-10-30 02:30", "Europe/Berlin", "ambiguous"), ("2022-01-13T24:00:01", "UTC", "impossible"), ("202201131200", "UTC", "unreadable"), ("13:00 PM", "UTC", "unreadable"),
]


def run(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, stamp string, date_order string, tz string, extra_zone string")
    return {r["i"]: r for r in T.resolve(T.parse(df, "stamp", "date_order", "tz")).collect()}


def test_forms(spark):
    got = run(spark, [(s, o, z, "x") for s, o, z, _ in CASES])
    assert {i: got[i]["utc_us"] for i in got} == {i: c[3] for i, c in enumerate(CASES)}


def test_no_instant(spark):
    got = run(spark, [(s, "dmy", z, None) for s, z, _ in NONE])
    assert [(got[i]["p_status"], got[i]["utc_us"]) for i in range(len(NONE))] == [(n[2], None) for n in NONE]


@pytest.mark.parametrize("zone", ["Europe/Berlin", "America/New_York", "Australia/Sydney", "Europe/London"])
def test_against_clock(spark, zone):
    """Every half hour of two years: the interval join agrees with a search over all instants that show that time."""
    z = zoneinfo.ZoneInfo(zone)
    begin = dt.datetime(2022, 1, 1)
    locals_ = [begin + dt.timedelta(minutes=30 * k) for k in range(0, 2 * 24 * 365 * 2, 7)] + [dt.datetime(2022, m, d, h, 30) for m, d in ((3, 27), (10, 30), (3, 13), (11, 6), (4, 3), (10, 2)) for h in (1, 2, 3)]
    df = spark.createDataFrame([(i, t.strftime("%Y-%m-%d %H:%M:%S"), zone) for i, t in enumerate(locals_)], "i int, stamp string, tz string").withColumn("date_order", F.lit("ymd"))
    got = {r["i"]: r["utc_us"] for r in T.resolve(T.parse(df, "stamp", "date_order", "tz")).collect()}
    for i, t in enumerate(locals_):
        hits = {int((t.replace(tzinfo=z, fold=f).astimezone(dt.UTC)).timestamp()) for f in (0, 1)}
        hits = {h for h in hits if dt.datetime.fromtimestamp(h, z).replace(tzinfo=None) == t}
        assert got[i] == (hits.pop() * 1_000_000 if len(hits) == 1 else None), t


def test_tables(spark):
    docs = spark.createDataFrame([(1, "A:B", "2023-01-01T00:00:00Z", None, "01.02.2023 10:00", "x")], "rec_id long, replica string, created string, modified string, revised string, tz string")
    fields = spark.createDataFrame([(7, "AB", "MeetingTimes", None, ["2023-01-01 10:00", None, "TBD", "2023-01-01 11:00"]), (8, "zz", "DueAt", "2023-01-01 10:00", None), (9, "A:B", "Subject", "2023-01-01 10:00", None)], "field_id long, replica string, name string, value string, value_list array<string>")
    dbs = spark.createDataFrame([("A:B", "Europe/Berlin", "dmy")], "replica string, tz string, date_order string")
    docs = docs.drop("tz")
    got = {tuple(r) for r in T.found(docs, fields, dbs).collect()}
    assert got == {("normalized_docs", 1, "revised", utc(2023, 2, 1, 9)), ("doc_fields", 7, "0", utc(2023, 1, 1, 9)), ("doc_fields", 7, "3", utc(2023, 1, 1, 10))}
    assert T.found(docs.limit(0), fields.limit(0), dbs).count() == 0
