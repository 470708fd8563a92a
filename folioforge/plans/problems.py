"""Queries of the general data problems: stamps, nested records, references."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import nested, references, timestamps
from folioforge.plans.stamps_sql import STAMPS
from folioforge.plans.walk_sql import NODES
from folioforge.session import table


def _stamp_tables(spark: SparkSession, base: str) -> list[DataFrame]:
    return [table(spark, base, t) for t in ("normalized_docs", "doc_fields", "note_dbs")]


def _reference_tables(spark: SparkSession, base: str) -> list[DataFrame]:
    return [table(spark, base, t) for t in ("link_notes", "doc_attachments", "normalized_docs", "deletion_stubs")]


def _p1_found(spark: SparkSession, base: str) -> DataFrame:
    return timestamps.found(*_stamp_tables(spark, base))


def _p1_report(spark: SparkSession, base: str) -> DataFrame:
    every = timestamps.normalise_stamps(*_stamp_tables(spark, base))
    return every.groupBy("src_table", F.col("p_status").alias("status")).agg(F.count("*").alias("stamps"))


def _p3_found(spark: SparkSession, base: str) -> DataFrame:
    return nested.found(table(spark, base, "raw_records"))


def _p3_tables(spark: SparkSession, base: str) -> DataFrame:
    every = nested.tables(nested.flatten(table(spark, base, "raw_records")))
    return every.withColumn("dewey", F.array_join(F.col("dewey").cast("array<string>"), "."))


def _p3_report(spark: SparkSession, base: str) -> DataFrame:
    return nested.report(table(spark, base, "raw_records"))


def _p4_found(spark: SparkSession, base: str) -> DataFrame:
    return references.find(*_reference_tables(spark, base)).select("ref_table", "ref_id")


def _p4_report(spark: SparkSession, base: str) -> DataFrame:
    return references.report(references.find(*_reference_tables(spark, base)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": _p1_found, "p1_report": _p1_report, "p3_found": _p3_found, "p3_tables": _p3_tables, "p3_report": _p3_report, "p4_found": _p4_found, "p4_report": _p4_report,
}

_ORPHANS = r"""
WITH ev AS (
  SELECT upper(regexp_replace(unid, '[^0-9A-Za-z]', '', 'g')) AS u, upper(regexp_replace(replica, '[^0-9A-Za-z]', '', 'g')) AS r, received_at AS tm, 1 AS alive
  FROM normalized_docs WHERE unid IS NOT NULL
  UNION ALL
  SELECT upper(regexp_replace(unid, '[^0-9A-Za-z]', '', 'g')), upper(regexp_replace(replica, '[^0-9A-Za-z]', '', 'g')), deleted_at, 0 FROM deletion_stubs
), named AS (
  SELECT 'link_notes' AS ref_table, link_id AS ref_id,
    coalesce(nullif(regexp_replace(unid, '[\s\x{00A0}]', '', 'g'), ''), nullif(regexp_extract(raw, '(?i)^notes:/+[^/]*/([^/?]*)/[^/?]*/([^/?]*)', 2), '')) AS u,
    coalesce(nullif(regexp_replace(replica, '[\s\x{00A0}]', '', 'g'), ''), nullif(regexp_extract(raw, '(?i)^notes:/+[^/]*/([^/?]*)/[^/?]*/([^/?]*)', 1), ''), doc_replica) AS r, seen_at
  FROM link_notes
  UNION ALL
  SELECT 'doc_attachments', att_id, unid, replica, seen_at FROM doc_attachments
), refs AS (
  SELECT ref_table, ref_id, seen_at, regexp_replace(regexp_replace(upper(u), '^[^0-9A-Z]*OF([0-9A-F]{8}:[0-9A-F]{8})-ON', '\1'), '[^0-9A-Z]', '', 'g') AS u,
    regexp_replace(regexp_replace(upper(r), '\.NSF$', ''), '[^0-9A-Z]', '', 'g') AS r FROM named
), lasts AS (
  SELECT ref_table, ref_id, arg_max(alive, epoch_us(tm) * 2 + alive) AS alive
  FROM refs JOIN ev ON refs.u = ev.u AND refs.r = ev.r AND ev.tm <= refs.seen_at GROUP BY ref_table, ref_id
), orphans AS (
  SELECT ref_table, ref_id, seen_at FROM refs LEFT JOIN lasts USING (ref_table, ref_id) WHERE coalesce(alive, 0) = 0
)
"""

_VALUES = ", ".join(f"v ->> '$.{k}' AS {k}" for k in ("t", "type", "name", "text", "value", "width", "href", "label"))

SQL: dict[str, str] = {
    "p1_found": STAMPS + r"SELECT src_table, row_id, slot, utc_us FROM resolved WHERE utc_us IS NOT NULL AND NOT regexp_full_match(stamp, '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z')",
    "p1_report": STAMPS + "SELECT src_table, status, count(*)::BIGINT AS stamps FROM resolved GROUP BY src_table, status",
    "p3_found": NODES + "SELECT record_id, node_path, parent_path FROM nodes",
    "p3_tables": NODES + rf"""SELECT record_id, node_path, parent_path, array_to_string(dewey, '.') AS dewey, depth, "table", CASE WHEN starts_with("table", 'layout') THEN 'layout' ELSE regexp_extract("table", '([^.]+)$', 1) END AS kind,
  {_VALUES}, try_cast(v ->> '$.size' AS BIGINT) AS size, try_cast(v ->> '$.colspan' AS INT) AS colspan, try_cast(v ->> '$.rowspan' AS INT) AS rowspan FROM nodes""",
    "p3_report": NODES + f"""SELECT "table", count(*)::BIGINT AS n_rows, count(DISTINCT record_id)::BIGINT AS n_records, max(depth)::INT AS max_depth FROM nodes GROUP BY "table"
  UNION ALL SELECT '{nested.UNREADABLE}', 0, count(DISTINCT record_id), 0 FROM (SELECT record_id FROM raw_records WHERE record_id NOT IN (SELECT record_id FROM texts WHERE json_type(j) = 'OBJECT')) HAVING count(*) > 0""",
    "p4_found": _ORPHANS + "SELECT ref_table, ref_id FROM orphans",
    "p4_report": _ORPHANS + "SELECT ref_table, strftime(seen_at AT TIME ZONE 'UTC', '%Y-%m') AS month, count(*)::BIGINT AS orphans FROM orphans GROUP BY ALL",
}
