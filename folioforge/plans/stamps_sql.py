"""Stamps resolved in SQL: each written form by a pattern of its own, wall-clock times by the zones of the SQL engine."""

from __future__ import annotations

from folioforge.operators.timestamps import ABBREVIATIONS, ERAS, MONTHS

_NAMES = {
    "iso": ["y", "mo", "d"], "era": ["e", "y", "mo", "d"], "num": ["a", "b", "c"], "dm": ["d", "m", "y"], "md": ["m", "d", "y"],
}
_CLOCK = ["half", "h", "mi", "s", "f", "ap", "z", "br"]
_TIME = r"(午前|午後)?\s*(\d{1,2})(?::|時|h\s?)(\d{1,2})(?:(?::|分)(\d{1,2})(?:[.,](\d{1,9}))?)?[分秒]?\s*(am\b|pm\b|a\.\s?m\.|p\.\s?m\.)?(?:\s*uhr)?"
_ZONE = r"\s*(z|(?:utc|gmt)?[+-]\d{1,2}(?::?\d{2})?|[a-z]{1,5}|[a-z]+(?:/[a-z_+-]+){1,2})?\s*(?:\[([a-z]+(?:/[a-z_+-]+){0,2})\])?$"
_FORMS = {
    "iso": r"^(\d{4})[-/.年](\d{1,2})[-/.月](\d{1,2})(?:日?t|日?\s+|日)" + _TIME + _ZONE,
    "num": r"^(\d{1,2})[./-](\d{1,2})[./-](\d{4}|\d{2})(?:,?\s+|t)" + _TIME + _ZONE,
    "cpt": r"^(\d{4})(\d{2})(\d{2})t?(\d{2})(\d{2})(\d{2})(?:[.,](\d{1,9}))?" + _ZONE,
    "dm": r"^(?:\p{L}+\.?,\s*)?(\d{1,2})(?:\.|er)?\s+(?:de )?(\p{L}+)\.?\s+(?:de )?(\d{4}),?\s+(?:(?:à|um|om|at|às|alle|a las)\s+)?" + _TIME + _ZONE,
    "md": r"^(?:\p{L}+\.?,\s*)?(\p{L}+)\.?\s+(\d{1,2}),\s*(\d{4}),?\s+(?:at\s+)?" + _TIME + _ZONE,
    "era": r"^(令和|平成|昭和)(\d{1,2}|元)年(\d{1,2})月(\d{1,2})日\s*" + _TIME + _ZONE,
}
_ALL = ["y", "mo", "d", *_CLOCK]


def _map(pairs: dict) -> str:
    return "MAP {" + ", ".join(f"'{k}': {v}" for k, v in pairs.items()) + "}"


_MONTH = _map({w: f"'{k}'" for k, ws in enumerate(MONTHS, 1) for w in ws.split()})
_YEAR4 = "CASE WHEN length({0}) <= 2 THEN '20' || lpad({0}, 2, '0') ELSE {0} END"


def _row(form: str) -> str:
    """The parts of a stamp of one form as a struct of year, month, day and clock."""
    if form == "cpt":
        names, own = ["y", "mo", "d", "h", "mi", "s", "f", "z", "br"], {"half": "''", "ap": "''"}
    else:
        names, own = [*_NAMES[form], *_CLOCK], {}
    if form == "num":
        first = "date_order = 'ymd' AND length(x.c) <> 4"
        pick = lambda ymd, mdy, dmy: f"coalesce(CASE WHEN {first} THEN {ymd} WHEN date_order = 'mdy' THEN {mdy} WHEN date_order = 'dmy' THEN {dmy} END, '')"
        year = f"coalesce(CASE WHEN {first} THEN {_YEAR4.format('x.a')} WHEN date_order IN ('dmy', 'mdy') THEN {_YEAR4.format('x.c')} END, '')"
        own = {"y": year, "mo": pick("x.b", "x.a", "x.b"), "d": pick("x.c", "x.b", "x.a")}
    elif form in ("dm", "md"):
        own = {"mo": f"coalesce({_MONTH}[lower(x.m)], '')"}
    elif form == "era":
        own = {"y": f"({_map(ERAS)}[x.e] + CASE WHEN x.y = '元' THEN 1 ELSE x.y::INT END)::VARCHAR"}
    struct = ", ".join(f"'{n}': {own.get(n, f'x.{n}')}" for n in _ALL)
    listed = ", ".join(f"'{n}'" for n in names)
    return f"""SELECT src_table, row_id, slot, stamp, tz, date_order, {{{struct}}} AS p FROM (SELECT *, regexp_extract(s, '(?i){_FORMS[form]}', [{listed}]) AS x FROM clean WHERE form = '{form}')"""


_FORM = "CASE WHEN regexp_full_match(s, '\\d{9,10}|\\d{13}|\\d{16}') THEN 'epoch' " + " ".join(f"WHEN regexp_matches(s, '(?i){p}') THEN '{k}'" for k, p in _FORMS.items()) + " END"
_OFFSET = r"(?i)^(?:utc|gmt)?([+-])(\d{1,2}):?(\d{2})?$"

STAMPS = rf"""WITH zones AS (SELECT upper(regexp_replace(replica, '[^0-9A-Fa-f]', '', 'g')) AS k, any_value(tz) AS tz, any_value(date_order) AS date_order FROM note_dbs GROUP BY 1),
own AS (SELECT * FROM doc_fields WHERE name IN ('DueAt', 'MeetingTimes')),
every AS (
  SELECT 'normalized_docs' AS src_table, rec_id AS row_id, replica, unnest(['created', 'modified', 'revised']) AS slot, unnest([created, modified, revised]) AS stamp FROM normalized_docs
  UNION ALL SELECT 'doc_fields', field_id, replica, '0', value FROM own WHERE value IS NOT NULL
  UNION ALL SELECT 'doc_fields', field_id, replica, unnest(range(len(value_list)))::VARCHAR, unnest(value_list) FROM own WHERE value IS NULL),
clean AS (SELECT *, {_FORM} AS form FROM (SELECT src_table, row_id, slot, stamp, tz, date_order, trim(regexp_replace(regexp_replace(translate(stamp, '０１２３４５６７８９／：．，－＋', '0123456789/:.,-+'), '[\x{{3000}}\x{{00A0}}\x{{202F}}\x{{2009}}\t\r\n]', ' ', 'g'), '[\x{{200B}}\x{{200E}}\x{{200F}}\x{{2060}}\x{{FEFF}}]', '', 'g')) AS s
  FROM every LEFT JOIN zones ON upper(regexp_replace(replica, '[^0-9A-Fa-f]', '', 'g')) = k WHERE stamp IS NOT NULL)),
parts AS ({" UNION ALL ".join(_row(f) for f in _FORMS)}),
clocks AS (SELECT *, try_cast(p.h AS INT) AS h0, try_cast(p.mi AS INT) AS mi, coalesce(try_cast(p.s AS INT), 0) AS sec, coalesce(try_cast(substr(rpad(p.f, 6, '0'), 1, 6) AS BIGINT), 0) AS frac,
    p.half <> '' OR p.ap <> '' AS twelve, p.half = '午後' OR starts_with(lower(p.ap), 'p') AS pm, try_cast(lpad(p.y, 4, '0') || '-' || lpad(p.mo, 2, '0') || '-' || lpad(p.d, 2, '0') AS DATE) AS day FROM parts),
locals AS (SELECT *, CASE WHEN twelve THEN CASE WHEN h0 <= 12 THEN h0 % 12 + CASE WHEN pm THEN 12 ELSE 0 END END ELSE h0 END AS hour FROM clocks),
timed AS (SELECT src_table, row_id, slot, stamp, coalesce(day IS NOT NULL AND (hour <= 23 OR (hour = 24 AND NOT twelve AND mi = 0 AND sec = 0 AND frac = 0)) AND mi <= 59 AND sec <= 59, false) AS good,
    CASE WHEN day IS NOT NULL THEN (day - DATE '1970-01-01')::BIGINT * 86400000000 + (hour::BIGINT * 3600 + mi * 60 + sec) * 1000000 + frac END AS local_us,
    CASE WHEN regexp_matches(p.z, '{_OFFSET}') THEN (CASE WHEN contains(p.z, '-') THEN -1 ELSE 1 END) * (regexp_extract(p.z, '{_OFFSET}', 2)::INT * 60 + coalesce(try_cast(regexp_extract(p.z, '{_OFFSET}', 3) AS INT), 0))
      WHEN p.z <> '' AND NOT contains(p.z, '/') THEN {_map(ABBREVIATIONS)}[upper(p.z)] WHEN p.z = '' AND upper(p.br) IN ('UTC', 'GMT', 'Z') THEN 0 END AS minutes,
    p.z <> '' AND NOT contains(p.z, '/') AND NOT regexp_matches(p.z, '{_OFFSET}') AND {_map(ABBREVIATIONS)}[upper(p.z)] IS NULL AS strange,
    lower(CASE WHEN contains(p.z, '/') THEN p.z WHEN p.z = '' AND p.br <> '' THEN p.br ELSE tz END) AS zone FROM locals),
known AS (SELECT t.*, n.name AS zname FROM timed t LEFT JOIN (SELECT lower(name) AS l, any_value(name) AS name FROM pg_timezone_names() GROUP BY 1) n ON t.zone = n.l),
walls AS (SELECT *, epoch_us(timezone(coalesce(zname, 'UTC'), make_timestamp(local_us))) AS u FROM known WHERE good AND NOT strange AND minutes IS NULL),
shown AS (SELECT *, len(list_filter([0, -7200, -3600, -1800, 1800, 3600, 7200], lambda k: epoch_us(timezone(coalesce(zname, 'UTC'), make_timestamptz(u + k::BIGINT * 1000000))) = local_us)) AS times FROM walls),
resolved AS (
  SELECT src_table, row_id, slot, stamp, CASE WHEN length(s) <= 10 THEN try_cast(s AS BIGINT) * 1000000 WHEN length(s) = 13 THEN try_cast(s AS BIGINT) * 1000 ELSE try_cast(s AS BIGINT) END AS utc_us, 'ok' AS status FROM clean WHERE form = 'epoch'
  UNION ALL SELECT src_table, row_id, slot, stamp, NULL, CASE WHEN s = '' THEN 'missing' ELSE 'unreadable' END FROM clean WHERE form IS NULL
  UNION ALL SELECT src_table, row_id, slot, stamp, CASE WHEN good AND NOT strange THEN local_us - minutes::BIGINT * 60000000 END, CASE WHEN strange THEN 'unreadable' WHEN good THEN 'ok' ELSE 'impossible' END FROM timed WHERE strange OR NOT good OR minutes IS NOT NULL
  UNION ALL SELECT src_table, row_id, slot, stamp, CASE WHEN zname IS NOT NULL AND times = 1 THEN u END, CASE WHEN zname IS NULL THEN 'no_zone' WHEN times > 1 THEN 'ambiguous' WHEN times = 0 THEN 'nonexistent' ELSE 'ok' END FROM shown)
"""
