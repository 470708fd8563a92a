import datetime as dt
import random

from pyspark.sql import functions as F

from folioforge.operators import references as R

DOCS = "rec_id long, unid string, replica string, received_at timestamp"
STUBS = "stub_id long, replica string, unid string, deleted_at timestamp"
LINKS = "link_id long, doc_unid string, doc_replica string, raw string, replica string, unid string, seen_at timestamp, at string"
ATTS = "att_id long, unid string, replica string, seen_at timestamp, key string"


def t(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def find(spark, links, atts, docs, stubs, **k):
    args = (spark.createDataFrame(links, LINKS), spark.createDataFrame(atts, ATTS), spark.createDataFrame(docs, DOCS), spark.createDataFrame(stubs, STUBS))
    return {(r["ref_table"], r["ref_id"]) for r in R.find(*args, **k).collect()}


def test_spellings_and_times(spark):
    u, r = "0F6CE0FD" + "C13EF750" + "17CA6B20" + "8835883F", "36CDA4033B215E20"
    docs = [(1, u.lower(), "36CDA403:3B215E20", t(10)), (2, None, "36CDA403:3B215E20", t(0)), (3, u, "36CDA403:3B215E20", t(30))]
    stubs = [(1, "36CDA403:3B215E20", u, t(20))]
    of = f"OF{u[:8]}:{u[8:16]}-ON{u[16:24]}:{u[24:]}"
    atts = [(1, of, f"__{r}", t(11), "x"), (2, "-".join(u[i : i + 8] for i in range(0, 32, 8)), "36cda403 3b215e20", t(25), "x"), (3, f" {u} ", r, t(30), None), (4, u, r, t(9), None), (5, None, r, t(11), None), (6, "zz", r, t(11), None), (7, u, r, None, None)]
    links = [(1, "D", "36CDA403:3B215E20", f"notes:///S/{r.lower()}.nsf/0/{u.lower()}?OpenDocument", None, "", t(12), None), (2, "D", "36CDA403:3B215E20", "notes:///S", " ", u, t(12), None), (3, "D", r, f"Notes://S/{r}/0/{u}", None, None, t(21), None), (4, "D", r, None, None, None, t(12), None)]
    assert find(spark, links, atts, docs, stubs) == {("doc_attachments", 2), ("doc_attachments", 4), ("doc_attachments", 5), ("doc_attachments", 6), ("link_notes", 3), ("link_notes", 4)}
    assert find(spark, [], [], docs, stubs) == set()
    assert find(spark, links[:1], [], [], []) == {("link_notes", 1)}


def test_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)
    keys = [f"{rng.getrandbits(128):032X}" for _ in range(40)]
    rep = "AAAAAAAA:BBBBBBBB"
    docs = [(i, rng.choice(keys), rep, t(rng.randrange(200))) for i in range(120)]
    stubs = [(i, rep, rng.choice(keys), t(rng.randrange(200))) for i in range(40)]
    atts = [(i, keys[0] if i % 3 == 0 else rng.choice(keys), rep, t(rng.randrange(220)), None) for i in range(900)]
    events = {}
    for _, u, _, at in docs:
        events.setdefault(u, []).append((at, 1))
    for _, _, u, at in stubs:
        events.setdefault(u, []).append((at, 0))
    want = {("doc_attachments", i) for i, u, _, at, _ in atts if not max(((a, k) for a, k in events.get(u, []) if a <= at), default=(None, 0))[1]}
    assert find(spark, [], atts, docs, stubs) == want
    assert find(spark, [], atts, docs, stubs, part_rows=10, digits=1) == want
    assert find(spark, [], atts, docs, stubs, part_rows=10, digits=1, most=2) == want


def test_turns(spark):
    """Of any number of deliveries only the turns of the state remain."""
    key, rep = "A" * 32, "AAAAAAAA:BBBBBBBB"
    docs = [(i, key, rep, t(i)) for i in range(50)] + [(100 + i, "B" * 32, rep, t(i)) for i in range(50)]
    stubs = [(1, rep, key, t(20)), (2, rep, key, t(20)), (3, rep, key, t(60)), (4, None, key, t(5)), (5, rep, key, None)]
    got = {tuple(r) for r in R.events(spark.createDataFrame(docs, DOCS), spark.createDataFrame(stubs, STUBS)).select(F.substring("key", 1, 1), ((F.col("at") - 1704067200000000) / 3600000000).cast("int"), "alive").collect()}
    assert got == {("A", 0, 1), ("A", 60, 0), ("B", 0, 1)}
    assert [R.range_digits(n) for n in (0, 10**6, 10**9, 10**12)] == [3, 3, 4, 6]


def test_ranges_of_keys_with_one_beginning(spark):
    keys = [f"{'A' * 20}{i:04X}{'0' * 24}" for i in range(64)] + [f"{i:048X}" for i in range(3)]
    df = spark.createDataFrame([(k, 0, 1) for k in keys], "key string, at long, alive int")
    rounds = R.deeper(df, 3, most=10)
    assert rounds == [{"AAA": 24}]
    sizes = {r["range"]: r["count"] for r in R.ranged(df, 3, rounds).groupBy("range").count().collect()}
    assert sum(sizes.values()) == 67 and max(sizes.values()) <= 10 and sizes["000"] == 3


def test_report(spark):
    df = spark.createDataFrame([("a", 1, t(0)), ("a", 2, t(1)), ("a", 3, None)], "ref_table string, ref_id long, seen_at timestamp")
    assert {tuple(r) for r in R.report(df).collect()} == {("a", "2024-01", 2), ("a", None, 1)}
