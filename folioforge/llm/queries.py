"""Queries over the training-text operators. They run over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import garbled, langid, leakage, packing, pii
from folioforge.session import table


def _p2_found(spark: SparkSession, base: str) -> DataFrame:
    return garbled.found(*(table(spark, base, t) for t in ("doc_fields", "doc_attachments", "documents", "people_dir")))


def _p2_restored(spark: SparkSession, base: str) -> DataFrame:
    fields, attachments, documents, people = (table(spark, base, t) for t in ("doc_fields", "doc_attachments", "documents", "people_dir"))
    return garbled.restore(garbled.texts(fields, attachments), garbled.corpus_of(documents, people))


def _p5_found(spark: SparkSession, base: str) -> DataFrame:
    return pii.found(table(spark, base, "doc_fields"), table(spark, base, "people_dir"))


def _p5_readable(spark: SparkSession, base: str) -> DataFrame:
    return pii.redact(table(spark, base, "doc_fields"), table(spark, base, "people_dir"))


def _p6_containers(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack(table(spark, base, "documents"))


def _p6_report(spark: SparkSession, base: str) -> DataFrame:
    return packing.report(packing.pack(table(spark, base, "documents")))


def _p7_found(spark: SparkSession, base: str) -> DataFrame:
    return leakage.found(table(spark, base, "documents"), table(spark, base, "eval_items"))


def _p7_items(spark: SparkSession, base: str) -> DataFrame:
    return leakage.report(table(spark, base, "documents"), table(spark, base, "eval_items"))


def _p8_found(spark: SparkSession, base: str) -> DataFrame:
    return langid.found(table(spark, base, "documents"))


def _p8_segments(spark: SparkSession, base: str) -> DataFrame:
    return langid.label(table(spark, base, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": _p2_found, "p2_restored": _p2_restored, "p5_found": _p5_found, "p5_readable": _p5_readable, "p6_containers": _p6_containers,
    "p6_report": _p6_report, "p7_found": _p7_found, "p7_items": _p7_items, "p8_found": _p8_found, "p8_segments": _p8_segments,
}

# Width, case, invisible characters and markup out of the way, as far as SQL has means: full-width forms by their code
# points, half-width kana by composition.
_FULL = "".join(map(chr, range(0xFF01, 0xFF5F)))
_HALF = "".join(map(chr, range(0x21, 0x7F)))
_INVISIBLE = r"[\x{00AD}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{FEFF}]"
_TAGS = "b|i|u|s|em|strong|span|font|a|sub|sup|small|mark|code"


def _plain(text: str) -> str:
    out = f"regexp_replace({text}, '{_INVISIBLE}', '', 'g')"
    out = f"replace(translate({out}, '{_FULL}ºª²³¹', '{_HALF.replace(chr(39), chr(39) * 2)}oa231'), '™', 'TM')"
    out = f"regexp_replace(regexp_replace({out}, '(?i)</?(?:{_TAGS})\\b[^<>]{{{{0,200}}}}>', '', 'g'), '(?i)</?[a-z][a-z0-9]*\\b[^<>@]{{{{0,200}}}}>|&nbsp;|&#160;', ' ', 'g')".replace("{{", "{").replace("}}", "}")
    return f"replace(lower({out}), 'ß', 'ss')"


_WORDS = "regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}]+')"
_LEAKS = f"""WITH d AS (SELECT doc_id, {_WORDS.format(_plain('text'))} AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, lower(trim(lang)) = 'ja' AS ja, {_WORDS.format(_plain('text'))} AS w FROM eval_items WHERE text IS NOT NULL),
dw AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 11], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d WHERE len(w) >= 12)),
iw AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS x FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i WHERE NOT ja AND len(w) >= 12)),
dl AS (SELECT doc_id, array_to_string(w, '') AS t FROM d),
il AS (SELECT DISTINCT item_id, substr(t, k, 30) AS x FROM (SELECT item_id, t, unnest(range(1, length(t) - 28)) AS k FROM (SELECT item_id, array_to_string(w, '') AS t FROM i WHERE ja) WHERE length(t) >= 30)),
dx AS (SELECT DISTINCT doc_id, substr(t, k, 30) AS x FROM (SELECT doc_id, t, unnest(range(1, length(t) - 28)) AS k FROM dl WHERE length(t) >= 30 AND regexp_matches(t, '[぀-ヿ㐀-鿿]'))),
leaks AS (SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (x) UNION SELECT DISTINCT doc_id, item_id FROM dx JOIN il USING (x))
"""

#: The others can't be expressed in SQL; they are tested against brute force, round trips and held-out labels.
SQL: dict[str, str] = {
    "p7_items": _LEAKS.replace("SELECT DISTINCT doc_id, array", "SELECT doc_id, k, array").replace("SELECT DISTINCT item_id, array", "SELECT item_id, k, array").replace("SELECT DISTINCT item_id, substr", "SELECT item_id, k, substr").replace("SELECT DISTINCT doc_id, substr", "SELECT doc_id, k, substr")
    + """, met AS (SELECT doc_id, item_id, dw.k AS a, iw.k AS b, 11 AS more FROM dw JOIN iw USING (x) UNION ALL SELECT doc_id, item_id, dx.k, il.k, 29 FROM dx JOIN il USING (x)),
  runs AS (SELECT doc_id, item_id, count(*) + max(more) AS n FROM (SELECT *, a - row_number() OVER (PARTITION BY doc_id, item_id, a - b ORDER BY a) AS isle FROM met) GROUP BY doc_id, item_id, a - b, isle)
  SELECT e.item_id, suite, lang, count(DISTINCT doc_id)::BIGINT AS n_docs, coalesce(max(n), 0)::BIGINT AS longest FROM eval_items e LEFT JOIN runs r ON e.item_id = r.item_id GROUP BY e.item_id, suite, lang""",
    "p7_found": _LEAKS + "SELECT doc_id, item_id FROM leaks",
}
