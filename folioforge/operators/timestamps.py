"""Mixed timestamp formats and zones to one UTC instant.

Every written form is parsed with JVM expressions into (local microseconds, zone, offset). Stamps that carry an
offset are done at once. Wall-clock stamps are matched, as-of, with a table of zone-offset intervals exploded to
(zone, year): the intervals of that cell which contain the local time are kept. Two of them: the wall clock shows
that time twice. None: the clock skips it. One: its offset gives the instant. An abbreviation that the zone of the
database uses at that time means its offset there; any other has the one meaning that prevails.

The intervals are those of the zones in use, the databases' and those that stamps name, at most the names of the tz
database. Years before ``FIRST_YEAR`` share its first interval (local mean time; no zone changed its clock earlier);
years after ``LAST_YEAR`` repeat a year of the same length and weekdays, as the rules in force then go by these. So the
table is bounded whatever the data, is broadcast, and the stamps never shuffle.

Defined results: null, empty and unreadable stamps, dates without a time, impossible dates and times give
``utc_us = NULL`` with a ``status``; 24:00:00 is the midnight that ends the day; numbers of 9 or 10, 13 and 16 digits
count seconds, milliseconds and microseconds since 1970 (12 digits may be either a date or milliseconds and are
unreadable); repeated rows are kept row by row; an unknown zone gives ``no_zone``; zone names count in any case.
"""

from __future__ import annotations

import calendar
import datetime as dt
import zoneinfo
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_YEAR, LAST_YEAR = 1840, 2115
#: Years that stand for later ones: all lengths and weekdays, after the last rule that is bound to a single year.
_LATER = range(2088, 2116)
US = 1_000_000

# Abbreviations of zones and their offsets in minutes, where one meaning prevails.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "Z": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180, "IST": 330,
    "JST": 540, "KST": 540, "AEST": 600, "AEDT": 660, "ACST": 570, "ACDT": 630, "AWST": 480, "NZST": 720, "NZDT": 780, "NST": -210, "NDT": -150,
    "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "HST": -600,
}

# Month names of the languages in use, by month.
MONTHS = [
    "jan january januar janvier enero janeiro gennaio januari jänner ene gen",
    "feb february februar février fevrier febrero fevereiro febbraio februari fev févr",
    "mar march märz maerz mars marzo março maart mrt mär",
    "apr april avril abril aprile avr abr",
    "may mai mayo maio maggio mei mag",
    "jun june juni juin junio junho giugno giu",
    "jul july juli juillet julio julho luglio lug juil",
    "aug august août aout agosto augustus ago",
    "sep sept september septembre septiembre setembro settembre set",
    "oct october oktober octobre octubre outubro ottobre okt out ott",
    "nov november novembre noviembre novembro",
    "dec december dezember décembre decembre diciembre dezembro dicembre dez dic déc",
]

# First year minus one of the Japanese eras.
ERAS = {"令和": 2018, "平成": 1988, "昭和": 1925}

_TIME = r"(午前|午後)?\s*(\d{1,2})(?::|時|h\s?)(\d{1,2})(?:(?::|分)(\d{1,2})(?:[.,](\d{1,9}))?)?[分秒]?\s*(?:(am|pm|a\.\s?m\.|p\.\s?m\.)(?![a-z]))?(?:\s*uhr)?"
_ZONE = r"\s*(z|(?:utc|gmt)?[+-]\d{1,2}(?::?\d{2})?|[a-z]{1,5}|[a-z]+(?:/[a-z_+-]+){1,2})?\s*(?:\[([a-z]+(?:/[a-z_+-]+){0,2})\])?"
_TAIL = _TIME + _ZONE + r"$"
_ISO = r"(?i)^(\d{4})[-/.年](\d{1,2})[-/.月](\d{1,2})日?(?:t|\s+|(?<=日))" + _TAIL
_ERA = r"(?i)^(令和|平成|昭和)(\d{1,2}|元)年(\d{1,2})月(\d{1,2})日\s*" + _TAIL
_COMPACT = r"(?i)^(\d{4})(\d{2})(\d{2})t?(\d{2})(\d{2})(\d{2})(?:[.,](\d{1,9}))?" + _ZONE + "$"
_NUMERIC = r"(?i)^(\d{1,2})[./-](\d{1,2})[./-](\d{4}|\d{2})(?:,?\s+|t)" + _TAIL
_DAY_MONTH = r"(?i)^(?:\p{L}+\.?,\s*)?(\d{1,2})(?:\.|er)?\s+(?:de )?(\p{L}+)\.?\s+(?:de )?(\d{4}),?\s+(?:(?:à|um|om|at|às|alle|a las)\s+)?" + _TAIL
_MONTH_DAY = r"(?i)^(?:\p{L}+\.?,\s*)?(\p{L}+)\.?\s+(\d{1,2}),\s*(\d{4}),?\s+(?:at\s+)?" + _TAIL
_EPOCH = r"^(\d{9,10}|\d{13}|\d{16})$"
_DONE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z$"


def _intervals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    step, utc = dt.timedelta(days=14), dt.UTC
    for pdf in batches:
        rows = []
        for key, name in zip(pdf["zone"], pdf["name"], strict=True):
            zone = zoneinfo.ZoneInfo(name)

            def state(t, zone=zone):
                here = t.replace(tzinfo=utc).astimezone(zone)
                return here.utcoffset(), here.tzname()

            begin, end = dt.datetime(FIRST_YEAR - 1, 12, 25), dt.datetime(LAST_YEAR + 1, 1, 8)
            cuts, at, now = [(begin, state(begin))], begin, state(begin)
            while at < end:
                after = min(at + step, end)
                if (then := state(after)) != now:
                    low, high = at, after
                    while high - low > dt.timedelta(seconds=1):
                        mid = low + dt.timedelta(seconds=int((high - low).total_seconds()) // 2)
                        low, high = (mid, high) if state(mid) == now else (low, mid)
                    now = state(high)
                    cuts.append((high, now))
                    after = high if now != then else after
                at = after
            for (start, (off, abbreviation)), (stop, _) in zip(cuts, [*cuts[1:], (end, None)], strict=True):
                us = lambda t, o=off: int((t + o - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
                lo, hi = us(start), us(stop)
                rows += [(key, y, int(off.total_seconds()), lo, hi, abbreviation.upper()) for y in range((start + off).year, (stop + off).year + 1)]
        yield pd.DataFrame(rows, columns=["zone", "year", "offset_s", "lo", "hi", "abbreviation"])


def zone_names() -> dict[str, str]:
    """Names of the tz database by their lower-case form."""
    return {z.lower(): z for z in sorted(zoneinfo.available_timezones()) if z not in ("localtime", "posixrules", "Factory")}


def zone_intervals(spark: SparkSession, zones: Iterable[str]) -> DataFrame:
    """One row per (zone in lower case, local year): ``spans`` lists the offset intervals that touch it, in local microseconds.

    Neighbours of equal offset that differ in their abbreviation only are told apart by it, not by their time.
    """
    names = zone_names()
    used = sorted({z.lower() for z in zones} & names.keys())
    width = max(1, min(32, len(used), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = spark.createDataFrame([(n, names[n]) for n in used], "zone string, name string").repartition(width, "zone")
    flat = rows.mapInPandas(_intervals, "zone string, year int, offset_s int, lo long, hi long, abbreviation string")
    return flat.groupBy("zone", "year").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "offset_s", "abbreviation"))).alias("spans"))


def zones_in_use(every: DataFrame) -> list[str]:
    """Known zones of the databases (``tz``) and those that the stamps name; at most as many as the tz database has."""
    named = F.regexp_extract_all("stamp", F.lit(r"([A-Za-z_]+(?:/[A-Za-z_+-]+){1,2}|\[[A-Za-z]+\])"), F.lit(1))
    wanted = F.array_append(F.when(F.col("stamp").rlike(r"[A-Za-z]/[A-Za-z]|\["), named).otherwise(F.array().cast("array<string>")), F.col("tz"))
    return _known(every.select(F.explode(wanted).alias("z")).select(F.lower(F.translate("z", "[]", "")).alias("zone")))


def _known(zones: DataFrame) -> list[str]:
    known = zones.sparkSession.createDataFrame([(z,) for z in zone_names()], "zone string")
    return [r["zone"] for r in zones.join(F.broadcast(known), "zone", "left_semi").distinct().collect()]


def _later() -> dict[int, tuple[int, int]]:
    """Representative year and its first day (days since 1970), by weekday of 1 January and length of the year."""
    out = {}
    for y in _LATER:
        first = dt.date(y, 1, 1)
        out[first.weekday() + 7 * calendar.isleap(y)] = (y, (first - dt.date(1970, 1, 1)).days)
    return out


def _fold(local: Column) -> tuple[Column, Column]:
    """(year of the interval table, local time there): as it is within the table, else of the year that stands for it."""
    year = F.year(F.timestamp_micros(local))
    first = F.make_date(year, F.lit(1), F.lit(1))
    leap = F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) == 366
    same = F.element_at(F.create_map(*[F.lit(x) for k, (y, d) in _later().items() for x in (k, F.struct(F.lit(y).alias("y"), F.lit(d).alias("d")))]), F.weekday(first) + F.when(leap, 7).otherwise(0))
    shift = (same["d"] - F.unix_date(first)).cast("long") * 86_400 * US
    start = (dt.date(FIRST_YEAR, 1, 2) - dt.date(1970, 1, 1)).days * 86_400 * US
    return F.when(year > LAST_YEAR, same["y"]).otherwise(F.greatest(year, F.lit(FIRST_YEAR))), F.when(year > LAST_YEAR, local + shift).when(year < FIRST_YEAR, F.lit(start)).otherwise(local)


def _split(stamp: Column, patterns: dict[str, tuple[str, int]]) -> Column:
    """Name of the first pattern that matches and its groups; the others aren't tried any more. Null if none does."""
    out = None
    for name, (pattern, groups) in patterns.items():
        parts = F.split(F.regexp_replace(stamp, F.lit(pattern), F.lit("¦".join([name, *(f"${i}" for i in range(1, groups + 1))]))), "¦")
        out = F.when(stamp.rlike(pattern), parts) if out is None else out.when(stamp.rlike(pattern), parts)
    return out


def _month(word: Column) -> Column:
    names = F.create_map(*[F.lit(x) for k, ws in enumerate(MONTHS, 1) for w in ws.split() for x in (w, str(k))])
    return F.element_at(names, F.lower(word))


def parse(df: DataFrame, stamp: str, date_order: str, zone: str) -> DataFrame:
    """Add ``p_local`` (local us), ``p_zone``, ``p_offset`` (s), ``p_name`` (abbreviation) and ``p_status`` for the column ``stamp``.

    ``p_status``: ``ok`` or why not: ``missing``, ``unreadable``, ``impossible``.
    """
    wide, ascii_ = "０１２３４５６７８９／：．，－＋　   \t\r\n", "0123456789/:.,-+       "
    s = F.trim(F.regexp_replace(F.translate(F.col(stamp), wide, ascii_), r"[​‎‏⁠﻿]", ""))
    df = df.withColumn("_s", s)
    s = F.col("_s")
    df = df.withColumn("_a", _split(s, {"iso": (_ISO, 11), "num": (_NUMERIC, 11), "cpt": (_COMPACT, 9), "dm": (_DAY_MONTH, 11), "md": (_MONTH_DAY, 11), "era": (_ERA, 12)}))
    get = lambda a, i: F.get(a, F.lit(i))
    g = lambda i: get(F.col("_a"), i)
    form, order, none = g(0), F.col(date_order), F.lit("")
    base = F.create_map(*[F.lit(x) for k, v in ERAS.items() for x in (k, v)])
    era_year = (F.element_at(base, g(1)) + F.when(g(2) == "元", 1).otherwise(g(2).try_cast("int"))).cast("string")
    year4 = lambda y: F.when(F.length(y) <= 2, F.concat(F.lit("20"), F.lpad(y, 2, "0"))).otherwise(y)
    year_first = (order == "ymd") & (F.length(g(3)) != 4)
    n_year = F.when(year_first, year4(g(1))).when(order.isin("dmy", "mdy"), year4(g(3)))
    n_month = F.when(year_first, g(2)).when(order == "mdy", g(1)).when(order == "dmy", g(2))
    n_day = F.when(year_first, g(3)).when(order == "mdy", g(2)).when(order == "dmy", g(1))
    # Each branch gives: year, month, day, half-of-day, hour, minute, second, fraction, am/pm, zone, bracketed zone.
    row = lambda *c, tail=(): F.array(*[F.coalesce(x, none) for x in (*c, *map(g, tail))])
    df = df.withColumn(
        "_p",
        F.when(form == "iso", row(tail=range(1, 12)))
        .when(form == "num", row(n_year, n_month, n_day, tail=range(4, 12)))
        .when(form == "cpt", row(g(1), g(2), g(3), none, g(4), g(5), g(6), g(7), none, g(8), g(9)))
        .when(form == "dm", row(g(3), _month(g(2)), g(1), tail=range(4, 12)))
        .when(form == "md", row(g(3), _month(g(1)), g(2), tail=range(4, 12)))
        .when(form == "era", row(era_year, g(3), g(4), tail=range(5, 13))),
    )
    p = F.col("_p")
    number = lambda i: get(p, i).try_cast("int")
    day = F.concat_ws("-", F.lpad(get(p, 0), 4, "0"), F.lpad(get(p, 1), 2, "0"), F.lpad(get(p, 2), 2, "0")).try_cast("date")
    half = F.lower(F.regexp_replace(get(p, 8), r"[.\s]", ""))
    pm = (get(p, 3) == "午後") | (half == "pm")
    twelve = (get(p, 3) != "") | (half != "")
    hour = F.when(twelve, F.when(number(4) <= 12, number(4) % 12 + F.when(pm, 12).otherwise(0))).otherwise(number(4))
    minute, second_ = number(5), F.coalesce(number(6), F.lit(0))
    fraction = F.coalesce(F.substring(F.rpad(get(p, 7), 6, "0"), 1, 6).try_cast("long"), F.lit(0))
    midnight = (number(4) == 24) & ~twelve & (minute == 0) & (second_ == 0) & (fraction == 0)
    good = day.isNotNull() & ((hour <= 23) | midnight) & (minute <= 59) & (second_ <= 59)
    local = F.unix_date(day).cast("long") * 86_400 * US + (hour.cast("long") * 3600 + minute * 60 + second_) * US + fraction
    mark, bracket = get(p, 9), get(p, 10)
    digits = F.regexp_replace(mark, r"(?i)^(utc|gmt)?[+-]|:", "")
    sign = F.when(F.contains(mark, F.lit("-")), -1).otherwise(1)
    written = sign * F.when(F.length(digits) <= 2, digits.try_cast("int") * 3600).otherwise(F.substring(digits, 1, F.length(digits) - 2).try_cast("int") * 3600 + F.right(digits, F.lit(2)).try_cast("int") * 60)
    minutes = F.element_at(F.create_map(*[F.lit(x) for k, v in ABBREVIATIONS.items() for x in (k, v)]), F.upper(mark))
    named = mark.contains("/")
    offset = F.when(mark.rlike(r"(?i)^(utc|gmt)?[+-]\d"), written).when((mark != "") & ~named, minutes * 60).when((mark == "") & F.upper(bracket).isin("UTC", "GMT", "Z"), F.lit(0))
    zone_ = F.lower(F.when(named, mark).when((mark == "") & (bracket != ""), bracket).otherwise(F.col(zone)))
    epoch = F.when(s.rlike(_EPOCH), s.try_cast("long") * F.when(F.length(s) <= 10, US).when(F.length(s) == 13, 1000).otherwise(1))
    unknown = (mark != "") & ~named & offset.isNull()
    return df.withColumns(
        {
            "p_local": F.coalesce(epoch, F.when(good, local)),
            "p_offset": F.when(epoch.isNotNull(), F.lit(0)).otherwise(offset),
            "p_zone": F.when(epoch.isNull() & ~F.coalesce(mark.rlike(r"(?i)^(utc|gmt)?[+-]\d"), F.lit(False)), zone_),
            "p_name": F.when(epoch.isNull() & minutes.isNotNull(), F.upper(mark)),
            "p_status": F.when(F.col(stamp).isNull() | (s == ""), "missing").when(epoch.isNotNull(), "ok").when(p.isNull() | unknown, "unreadable").when(good, "ok").otherwise("impossible"),
        }
    ).drop("_s", "_a", "_p")


def resolve(parsed: DataFrame, intervals: DataFrame | None = None) -> DataFrame:
    """As-of match of parsed local times with the zone intervals: adds ``utc_us`` and a final ``p_status``.

    ``p_status`` becomes ``ambiguous`` (the clock shows the time twice), ``nonexistent`` (it skips it) or ``no_zone``.
    """
    if intervals is None:
        intervals = zone_intervals(parsed.sparkSession, _known(parsed.select(F.coalesce("p_zone", F.lit("")).alias("zone"))))
    spans = intervals.select(F.col("zone").alias("_z"), F.col("year").alias("_y"), "spans")
    ok = F.col("p_status") == "ok"
    wall = ok & F.col("p_offset").isNull()
    year, local = _fold(F.col("p_local"))
    key = F.when(wall | (ok & F.col("p_name").isNotNull()), F.struct(F.col("p_zone").alias("z"), year.alias("y"), local.alias("t")))
    # A generated column: the planner would else write out the whole parser for each key, time and again.
    out = parsed.select("*", F.explode(F.array(key)).alias("_key"))
    out = out.join(F.broadcast(spans), (F.col("_key.z") == F.col("_z")) & (F.col("_key.y") == F.col("_y")), "left")
    hits = F.filter("spans", lambda x: (x["lo"] <= F.col("_key.t")) & (F.col("_key.t") < x["hi"]))
    hits = F.array_distinct(F.transform(F.when(wall, hits).otherwise(F.filter(hits, lambda x: x["abbreviation"] == F.col("p_name"))), lambda x: x["offset_s"]))
    out = out.withColumn("_hits", hits)
    n = F.size("_hits")
    offset = F.coalesce(F.when(n == 1, F.get(F.col("_hits"), F.lit(0))), F.col("p_offset"))
    status = F.when(wall & F.col("spans").isNull(), "no_zone").when(wall & (n > 1), "ambiguous").when(wall & (n == 0), "nonexistent").otherwise(F.col("p_status"))
    return out.withColumns({"utc_us": F.when(status == "ok", F.col("p_local") - offset.cast("long") * US), "p_status": status}).drop("_z", "_y", "_key", "spans", "_hits")


def stamps(docs: DataFrame, fields: DataFrame, dbs: DataFrame) -> DataFrame:
    """Every stamp of normalized_docs and doc_fields, one row each: src_table, row_id, slot, stamp, tz, date_order.

    A position of a list that holds null keeps its number and gives no row.
    """
    three = docs.select(F.lit("normalized_docs").alias("src_table"), F.col("rec_id").alias("row_id"), "replica", F.explode(F.create_map(F.lit("created"), "created", F.lit("modified"), "modified", F.lit("revised"), "revised")).alias("slot", "stamp"))
    own = fields.where(F.col("name").isin("DueAt", "MeetingTimes")).select("field_id", "replica", "value", "value_list")
    one = own.where(F.col("value").isNotNull()).select(F.lit("doc_fields").alias("src_table"), F.col("field_id").alias("row_id"), "replica", F.lit("0").alias("slot"), F.col("value").alias("stamp"))
    many = own.where(F.col("value").isNull()).select(F.lit("doc_fields").alias("src_table"), F.col("field_id").alias("row_id"), "replica", F.posexplode("value_list").alias("pos", "stamp"))
    many = many.select("src_table", "row_id", "replica", F.col("pos").cast("string").alias("slot"), "stamp")
    key = F.upper(F.regexp_replace("replica", "[^0-9A-Fa-f]", ""))
    zones = dbs.select(key.alias("_k"), "tz", "date_order").dropDuplicates(["_k"])
    every = three.union(one).union(many).where(F.col("stamp").isNotNull())
    # note_dbs is the manifest of databases: 36 rows at every scale.
    return every.withColumn("_k", key).join(F.broadcast(zones), "_k", "left").drop("_k")


def normalise_stamps(docs: DataFrame, fields: DataFrame, dbs: DataFrame) -> DataFrame:
    """All stamps with ``utc_us`` and ``p_status``."""
    every = stamps(docs, fields, dbs)
    return resolve(parse(every, "stamp", "date_order", "tz"), zone_intervals(every.sparkSession, zones_in_use(every)))


def found(docs: DataFrame, fields: DataFrame, dbs: DataFrame) -> DataFrame:
    """Stamps that denote exactly one instant and aren't yet written as UTC with a T and a Z."""
    every = normalise_stamps(docs, fields, dbs)
    return every.where(F.col("utc_us").isNotNull() & ~F.col("stamp").rlike(_DONE)).select("src_table", "row_id", "slot", "utc_us")
