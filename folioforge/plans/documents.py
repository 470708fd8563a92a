"""Queries of the document operators over whole tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as fn
from folioforge.operators import attachments, dedup, fields, progress, scan
from folioforge.operators.progress import note_key
from folioforge.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


# Pieces of SQL in common.
_NAME = "upper(trim(unid))"
_STEM = r"regexp_replace({0}, '([^.])\.[^.]+$', '\1')"
_SUFFIX = r"regexp_extract({0}, '[^.](\.[^.]+)$', 1)"
_BARE = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '[<>:"/\\|?* \x00-\x1f]', '_', 'g'), '^[ ._]+|[ ._]+$', '', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g')"""
_LATEST = """latest AS (SELECT db, unid, line_no, ts, status, try_no, err, out_path FROM (
  SELECT db, upper(trim(unid)) AS unid, line_no, ts, status, try_no, err, out_path, row_number() OVER (PARTITION BY db, upper(trim(unid)) ORDER BY line_no DESC, ts DESC NULLS LAST, status DESC NULLS LAST, try_no DESC NULLS LAST, err DESC NULLS LAST, out_path DESC NULLS LAST) AS rn
  FROM progress_log WHERE db IS NOT NULL AND unid IS NOT NULL AND line_no IS NOT NULL) WHERE rn = 1)"""
_FILES = "files AS (SELECT source || '/' || coalesce(form, 'NoForm') || '_' || doc_id || '.txt' AS path, strlen(text) AS size, added_at AS mtime, text AS content FROM documents WHERE text IS NOT NULL)"
_DUPS = _FILES + ", dups AS (SELECT path, size, mtime, sha256(content) AS hash, floor(epoch(mtime))::BIGINT AS mtime_s FROM files QUALIFY count(*) OVER (PARTITION BY size, sha256(content)) > 1)"
_COPY = r"regexp_full_match({0}, '(.*[_\-\s]\d+|.*\(\d+\)|.*copy|.*コピー)', 'is')"
_ITEMS = """own AS (
  SELECT upper(trim(unid)) AS unid, replica, name, type, ord, field_id, nullif(value, '') AS value, list_filter(value_list, lambda x: x IS NOT NULL) AS value_list FROM doc_fields),
good AS (SELECT unid, replica, name, type, ord, field_id, value, CASE WHEN len(value_list) > 0 THEN value_list END AS value_list FROM own
  WHERE name IS NOT NULL AND name <> '' AND NOT starts_with(name, '$') AND name <> 'Form' AND (value IS NOT NULL OR len(value_list) > 0)),
items AS (SELECT unid, replica, name, min(ord) OVER (PARTITION BY unid, replica, name) AS ord, type, value, value_list FROM good
  QUALIFY row_number() OVER (PARTITION BY unid, replica, name ORDER BY good.ord DESC, field_id DESC) = 1)"""


def _files(spark: SparkSession, base: str) -> DataFrame:
    """Documents as files with a path, a size in bytes, a time and a content."""
    d = table(spark, base, "documents").where(F.col("text").isNotNull())
    path = F.concat(F.col("source"), F.lit("/"), F.coalesce("form", F.lit("NoForm")), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return d.select(path.alias("path"), F.octet_length("text").alias("size"), F.col("added_at").alias("mtime"), F.encode("text", "UTF-8").alias("content"))


# Progress of the job


@query("progress_latest", f"WITH {_LATEST} SELECT * FROM latest")
def _(spark, base):
    return progress.latest(table(spark, base, "progress_log"))


@query("progress_summary", f"WITH {_LATEST} SELECT status, count(*)::BIGINT AS n_keys, max(try_no)::INT AS max_try FROM latest GROUP BY status")
def _(spark, base):
    return progress.summary(table(spark, base, "progress_log"))


_WORK = f"cand AS (SELECT DISTINCT db_title AS db, {_NAME} AS unid FROM normalized_docs WHERE unid IS NOT NULL)"


def _candidates(spark, base):
    return table(spark, base, "normalized_docs").where(F.col("unid").isNotNull()).select(F.col("db_title").alias("db"), progress.note_key(F.col("unid")).alias("unid"))


@query("progress_remaining", f"WITH {_LATEST}, {_WORK} SELECT db, unid, status, coalesce(try_no, 0)::INT AS tries FROM cand LEFT JOIN latest USING (db, unid) WHERE NOT coalesce(status IN ('done', 'skipped') OR (status = 'error' AND coalesce(try_no, 0) >= 3), false)")
def _(spark, base):
    return progress.remaining(_candidates(spark, base), table(spark, base, "progress_log"))


@query("progress_retry_errors", f"WITH {_LATEST} SELECT db, unid, try_no, err FROM latest WHERE status = 'error' AND coalesce(try_no, 0) < 3")
def _(spark, base):
    return progress.retry_errors(table(spark, base, "progress_log"))


@query("progress_drop_by_keyword", "SELECT line_no, db, unid, status FROM progress_log p WHERE NOT EXISTS (SELECT 1 FROM progress_log q WHERE contains(q.out_path, 'Archive') AND upper(trim(q.unid)) = upper(trim(p.unid)))")
def _(spark, base):
    return progress.drop_by_keyword(table(spark, base, "progress_log"), "Archive").select("line_no", "db", "unid", "status")


_ISLE = "isle AS (SELECT db, upper(trim(unid)) AS unid, line_no, status, err, ts, sum(ch) OVER (PARTITION BY db, upper(trim(unid)) ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN status = lag(status) OVER (PARTITION BY db, upper(trim(unid)) ORDER BY line_no) THEN 0 ELSE 1 END AS ch FROM progress_log))"


@query("list_numbering", f"WITH {_ISLE} SELECT db, unid, line_no, status, island::BIGINT AS island, row_number() OVER (PARTITION BY db, unid, island ORDER BY line_no)::INT AS pos FROM isle")
def _(spark, base):
    return progress.islands(table(spark, base, "progress_log")).select("db", "unid", "line_no", "status", "island", "pos")


@query("adjacent_merge", f"WITH {_ISLE} SELECT db, unid, island::BIGINT AS island, status, min(line_no) AS first_line, max(line_no) AS last_line, count(*)::BIGINT AS n_lines, string_agg(ts, '|' ORDER BY line_no, ts) AS stamps FROM isle GROUP BY db, unid, island, status")
def _(spark, base):
    return progress.merged(table(spark, base, "progress_log"))


@query("repeat_suppress", "SELECT db, unid, line_no, status, err, try_no FROM (SELECT db, upper(trim(unid)) AS unid, line_no, status, err, try_no, lag(status) OVER w AS ls, lag(err) OVER w AS le, lag(line_no) OVER w AS ll FROM progress_log WINDOW w AS (PARTITION BY db, upper(trim(unid)) ORDER BY line_no)) WHERE NOT (ls IS NOT DISTINCT FROM status AND le IS NOT DISTINCT FROM err AND ll IS NOT NULL)")
def _(spark, base):
    return progress.suppressed(table(spark, base, "progress_log"))


@query("carry_forward", "SELECT db, upper(trim(unid)) AS unid, line_no, status, err, last_value(err IGNORE NULLS) OVER w AS last_err, count(*) FILTER (status = 'processing') OVER w AS starts FROM progress_log WINDOW w AS (PARTITION BY db, upper(trim(unid)) ORDER BY line_no ROWS UNBOUNDED PRECEDING)")
def _(spark, base):
    return progress.carried(table(spark, base, "progress_log"))


@query("limit_keys", "SELECT db, upper(trim(unid)) AS unid, min(line_no) AS first_line FROM progress_log GROUP BY ALL ORDER BY first_line, db, unid LIMIT 100")
def _(spark, base):
    return progress.first_keys(table(spark, base, "progress_log"), 100)


@query("stem_join", r"SELECT line_no, regexp_extract(out_path, '([^/]*)\.[^./]+$', 1) AS unid, regexp_extract(out_path, '([^/]*)\.[^./]+$', 1) IN (SELECT upper(trim(unid)) FROM normalized_docs WHERE unid IS NOT NULL) AS matched FROM progress_log WHERE out_path IS NOT NULL")
def _(spark, base):
    log = table(spark, base, "progress_log").where(F.col("out_path").isNotNull()).select("line_no", F.regexp_extract("out_path", r"([^/]*)\.[^./]+$", 1).alias("unid"))
    docs = table(spark, base, "normalized_docs").select(note_key(F.col("unid")).alias("unid"))
    return scan.matched(log, docs, "unid").select("line_no", "unid", "matched")


# Scans


@query("manifest_views", "SELECT replica, title, (unnest(range(len(v)))) ::INT AS view_ord, unnest(v) AS view FROM (SELECT replica, title, CASE WHEN len(views) > 0 THEN views WHEN view_name IS NOT NULL THEN [view_name] ELSE ['($All)', 'AllDocuments', 'All Documents', 'すべての文書', '全ての文書', 'すべてのドキュメント'] END AS v FROM note_dbs WHERE title IS NOT NULL AND db_file IS NOT NULL)")
def _(spark, base):
    return scan.manifest(table(spark, base, "note_dbs"))


_VIEWS = """views AS (SELECT upper(trim(unid)) AS key, CASE WHEN form = 'Memo' THEN 0 WHEN form = 'Minutes' THEN 1 END AS view_ord, rec_id AS pos FROM normalized_docs WHERE form IN ('Memo', 'Minutes')
  UNION ALL SELECT upper(trim(unid)), 2, rec_id FROM normalized_docs)"""


@query("ordered_distinct_union", f"WITH {_VIEWS} SELECT key, (min(view_ord * 1000000000000 + pos) // 1000000000000)::INT AS view_ord, (min(view_ord * 1000000000000 + pos) % 1000000000000)::BIGINT AS pos FROM views WHERE key IS NOT NULL GROUP BY key")
def _(spark, base):
    d = table(spark, base, "normalized_docs").select(note_key(F.col("unid")).alias("unid"), "rec_id", "form")
    return scan.ordered_union([d.where("form = 'Memo'"), d.where("form = 'Minutes'"), d], "unid", "rec_id")


@query("scan_fallback", "SELECT rec_id, unid FROM normalized_docs WHERE form = 'Circular' OR NOT EXISTS (SELECT 1 FROM normalized_docs WHERE form = 'Circular')")
def _(spark, base):
    d = table(spark, base, "normalized_docs")
    return scan.with_fallback(d.where("form = 'Circular'").select("rec_id", "unid"), d.select("rec_id", "unid"))


@query("childless_parents", "SELECT replica, title FROM note_dbs WHERE replica NOT IN (SELECT replica FROM link_notes WHERE replica IS NOT NULL)")
def _(spark, base):
    return scan.childless(table(spark, base, "note_dbs").select("replica", "title"), table(spark, base, "link_notes"), "replica")


@query("files_since", f"WITH {_FILES} SELECT path, epoch_us(mtime)::BIGINT AS mtime_us FROM files WHERE ends_with(lower(path), '.txt') AND mtime >= TIMESTAMPTZ '2024-06-01 00:00:00+00'")
def _(spark, base):
    files = _files(spark, base).withColumnRenamed("mtime", "created")
    return scan.since(files, ".TXT", "2024-06-01 00:00:00").select("path", F.unix_micros("created").alias("mtime_us"))


@query("path_guard", "WITH p AS (SELECT att_id, CASE att_id % 4 WHEN 0 THEN content_path WHEN 1 THEN '../' || content_path WHEN 2 THEN replace(content_path, 'attachments/', 'attachments/../attachments2/') ELSE replace(content_path, 'attachments/', 'x/.././attachments/y/../') END AS path FROM doc_attachments WHERE content_path IS NOT NULL), c AS (SELECT att_id, path, regexp_replace(regexp_replace(replace(path, '/./', '/'), '(^|/)[^/.][^/]*/\\.\\./', '\\1', 'g'), '//+', '/', 'g') AS plain FROM p) SELECT att_id, path, starts_with(plain, 'attachments/') AS inside FROM c")
def _(spark, base):
    path, k = F.col("content_path"), F.col("att_id") % 4
    out = lambda to: F.replace(path, F.lit("attachments/"), F.lit(to))
    made = F.when(k == 0, path).when(k == 1, F.concat(F.lit("../"), path)).when(k == 2, out("attachments/../attachments2/")).otherwise(out("x/.././attachments/y/../"))
    each = table(spark, base, "doc_attachments").where(path.isNotNull()).select("att_id", made.alias("path"))
    return each.withColumn("inside", scan.inside(F.col("path"), "attachments"))


# Duplicates


@query("dup_groups", f"WITH {_DUPS} SELECT path, size::INT AS size, hash FROM dups")
def _(spark, base):
    return dedup.duplicates(_files(spark, base)).select("path", "size", "hash")


@query("dup_groups_strict", f"WITH {_DUPS} SELECT path, hash, mtime_s FROM dups QUALIFY count(*) OVER (PARTITION BY size, hash, mtime_s) > 1")
def _(spark, base):
    return dedup.duplicates(_files(spark, base), strict_mtime=True).select("path", "hash", "mtime_s")


_RANK = _DUPS + r", named AS (SELECT *, regexp_extract(path, '([^/\\]*)$', 1) AS name FROM dups), ranked AS (SELECT path, size, hash, CASE WHEN row_number() OVER (PARTITION BY hash ORDER BY " + _COPY.format(_STEM.format("name")) + "::INT, length(name), lower(path), path) = 1 THEN 'keep' ELSE 'delete' END AS action FROM named)"
_UNITS = "CASE WHEN {0} < 1024 THEN round_even({0}::DOUBLE, 0)::BIGINT || ' B' WHEN {0} < 1048576 THEN round_even({0} / 1024.0::DOUBLE, 0)::BIGINT || ' KB' WHEN {0} < 1073741824 THEN round_even({0} / 1048576.0::DOUBLE, 0)::BIGINT || ' MB' ELSE round_even({0} / 1073741824.0::DOUBLE, 0)::BIGINT || ' GB' END"


@query("dup_keep_delete", f"WITH {_RANK} SELECT path, action, size::INT AS size_bytes, {_UNITS.format('size')} AS size_human, hash FROM ranked")
def _(spark, base):
    return dedup.report(_files(spark, base))


@query("dup_totals", f"WITH {_DUPS}, g AS (SELECT hash, count(*) AS n, max(size) AS size FROM dups GROUP BY hash) SELECT count(*)::BIGINT AS n_groups, coalesce(sum(n), 0)::BIGINT AS n_files, coalesce(sum(n - 1), 0)::BIGINT AS n_delete, coalesce(sum((n - 1) * size), 0)::BIGINT AS bytes_delete FROM g")
def _(spark, base):
    return dedup.totals(_files(spark, base))


@query("dup_group_numbers", f"WITH {_DUPS} SELECT size::INT AS size, hash, count(*)::BIGINT AS n, row_number() OVER (ORDER BY size, hash)::BIGINT AS group_no FROM dups GROUP BY size, hash")
def _(spark, base):
    groups = dedup.duplicates(_files(spark, base)).groupBy("size", "hash").agg(F.count("*").alias("n"))
    return dedup.numbered(groups, ["size", "hash"])


# Items of notes


@query("item_values", f"WITH {_ITEMS} SELECT unid, replica, name, ord, type, value, array_to_string(value_list, '|') AS value_list FROM items")
def _(spark, base):
    return fields.items(table(spark, base, "doc_fields")).withColumn("value_list", F.array_join("value_list", "|"))


@query("item_typed", f"WITH {_ITEMS}, n AS (SELECT *, try_cast(replace(value, ',', '.') AS DOUBLE) AS num FROM items) SELECT unid, replica, name, CASE WHEN value_list IS NOT NULL THEN 'list' WHEN starts_with(type, 'number') AND num IS NOT NULL THEN 'number' ELSE 'text' END AS kind, coalesce(len(value_list), 0)::INT AS n_list, CASE WHEN starts_with(type, 'number') THEN num END AS number, coalesce(value, array_to_string(value_list, ', ')) AS text FROM n")
def _(spark, base):
    return fields.typed(table(spark, base, "doc_fields"))


_PREVIEW = "(CASE WHEN length(p) > 200 THEN substr(p, 1, 200) || ' …' ELSE p END)"


@query("appendix_rows", f"WITH {_ITEMS}, p AS (SELECT unid, replica, name, type, coalesce(array_to_string(value_list[1:5], ', ') || CASE WHEN len(value_list) > 5 THEN ' …' ELSE '' END, value, '') AS p FROM items WHERE name NOT IN ('Subject', 'From', 'To', 'CC', 'Body', 'Categories', 'Created', 'Modified')) SELECT unid, replica, name, type, {_PREVIEW} AS preview, row_number() OVER (PARTITION BY unid, replica ORDER BY lower(name), name)::INT AS pos FROM p")
def _(spark, base):
    return fields.appendix(table(spark, base, "doc_fields"))


_SAFE = "CASE WHEN coalesce({0}, '') = '' THEN 'NoName' WHEN substr(" + _BARE + ", 1, 50) = '' THEN '_sanitized_' ELSE substr(" + _BARE + ", 1, 50) END"


@query("safe_names", "SELECT field_id, " + _SAFE.format("value") + " AS safe FROM doc_fields WHERE name = 'Subject'")
def _(spark, base):
    return table(spark, base, "doc_fields").where("name = 'Subject'").select("field_id", fn.safe_name(F.col("value")).alias("safe"))


_DAY = r"CASE WHEN coalesce(created, '') = '' THEN 'NODATE' WHEN regexp_full_match(created, '\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?') AND try_cast(substr(created, 1, 10) AS DATE) IS NOT NULL AND coalesce(try_cast(nullif(substr(created, 12, 2), '') AS INT), 0) <= 23 AND coalesce(try_cast(nullif(substr(created, 15, 2), '') AS INT), 0) <= 59 THEN strftime(try_cast(substr(created, 1, 10) AS DATE), '%Y%m%d') ELSE 'INVALIDDATE' END"


@query("iso_days", f"SELECT rec_id, {_DAY} AS day FROM normalized_docs")
def _(spark, base):
    return table(spark, base, "normalized_docs").select("rec_id", fn.iso_day(F.col("created")).alias("day"))


_PATHS = (
    f"WITH {_ITEMS}, wide AS (SELECT unid, replica, max(value) FILTER (name = 'Subject') AS sv, max(value_list) FILTER (name = 'Subject') AS sl, max(value) FILTER (name = 'Categories') AS cv, max(value_list) FILTER (name = 'Categories') AS cl FROM items WHERE name IN ('Subject', 'Categories') GROUP BY unid, replica), "
    f"j AS (SELECT d.rec_id, upper(trim(d.unid)) AS unid, db_title, form, {_DAY} AS day, sv, sl, cv, cl FROM normalized_docs d LEFT JOIN wide w ON upper(trim(d.unid)) = w.unid AND d.replica = w.replica WHERE d.unid IS NOT NULL), "
    r"t AS (SELECT *, CASE WHEN coalesce(regexp_replace(coalesce(sv, array_to_string(list_filter(sl, lambda x: trim(x) <> ''), ' ')), '\s', '', 'g'), '') = '' THEN 'NoTitle_' || unid ELSE coalesce(sv, array_to_string(list_filter(sl, lambda x: trim(x) <> ''), ' ')) END AS title, coalesce(cl, list_filter(list_transform(string_split(cv, ';'), lambda x: trim(x)), lambda x: x <> ''), []) AS cats FROM j) "
)
_HEAD = "array_to_string(list_concat([" + _SAFE.format("db_title") + ", " + _SAFE.format("coalesce(nullif(form, ''), 'NoForm')") + "], list_transform(cats[1:2], lambda x: " + _SAFE.format("x") + ")), '/')"


@query("out_paths", _PATHS + "SELECT rec_id, title, " + _HEAD + " || '/Doc_' || day || '_' || " + _SAFE.format("title") + " AS out_path FROM t")
def _(spark, base):
    return fields.paths(table(spark, base, "normalized_docs"), table(spark, base, "doc_fields")).select("rec_id", "title", "out_path")


@query("legacy_paths", _PATHS + r", s AS (SELECT *, regexp_split_to_array(title, '[\\/]+') AS parts FROM t) ".replace(", s AS", ", s AS") + "SELECT rec_id, " + _HEAD + " || '/' || array_to_string(list_concat(['Doc_' || day || '_' || " + _SAFE.format("parts[1]") + "], list_transform(list_filter(parts[2:], lambda x: x <> ''), lambda x: " + _SAFE.format("x") + ")), '/') AS legacy_path FROM s")
def _(spark, base):
    return fields.paths(table(spark, base, "normalized_docs"), table(spark, base, "doc_fields")).select("rec_id", "legacy_path")


@query("link_kinds", "SELECT upper(trim(doc_unid)) AS doc_unid, CASE WHEN coalesce(trim(unid), '') <> '' THEN 'note' WHEN coalesce(trim(replica), '') <> '' THEN 'database' ELSE 'other' END AS kind, count(*)::BIGINT AS n_links, count(DISTINCT raw)::BIGINT AS n_targets FROM link_notes GROUP BY ALL")
def _(spark, base):
    return fields.links(table(spark, base, "link_notes"))


# Attachments


@query("attachment_order", "SELECT att_id, unid, name, type, row_number() OVER (PARTITION BY unid ORDER BY name NULLS FIRST, type NULLS FIRST, att_id)::INT AS ord FROM doc_attachments")
def _(spark, base):
    return attachments.ordered(table(spark, base, "doc_attachments"))


@query("attachment_refs", "WITH f AS (SELECT * FROM doc_attachments WHERE type = 'file' AND content_path IS NOT NULL), d AS (SELECT unid, saved_name AS k, arg_min(content_path, att_id) AS p FROM f WHERE saved_name IS NOT NULL GROUP BY ALL), n AS (SELECT unid, name AS k, arg_max(content_path, att_id) AS p FROM f WHERE name IS NOT NULL GROUP BY ALL) SELECT a.att_id, a.unid, a.ref_name, coalesce(d.p, n.p) AS path, CASE WHEN d.p IS NOT NULL THEN 'display' WHEN n.p IS NOT NULL THEN 'name' END AS by FROM doc_attachments a LEFT JOIN d ON a.unid = d.unid AND a.ref_name = d.k LEFT JOIN n ON a.unid = n.unid AND a.ref_name = n.k WHERE a.ref_name IS NOT NULL")
def _(spark, base):
    return attachments.resolve(table(spark, base, "doc_attachments"))


@query("image_sequence", "SELECT att_id, unid, name, ref_index, (row_number() OVER (PARTITION BY unid ORDER BY ref_index NULLS LAST, att_id) - 1)::INT AS seq FROM doc_attachments WHERE type = 'image'")
def _(spark, base):
    return attachments.images(table(spark, base, "doc_attachments"))


@query("image_sources", "WITH r AS (SELECT DISTINCT unid, name AS alt FROM doc_attachments WHERE type = 'image' AND name IS NOT NULL), k AS (SELECT unid, att_id, 1 AS prio, name AS alt FROM doc_attachments WHERE type = 'image' UNION ALL SELECT unid, att_id, 2, " + _STEM.format("name") + " FROM doc_attachments WHERE type = 'image' UNION ALL SELECT unid, att_id, 3, saved_name FROM doc_attachments WHERE type = 'image'), b AS (SELECT unid, alt, arg_min(att_id, prio * 1000000000000 + att_id) AS image_id FROM k WHERE alt IS NOT NULL GROUP BY ALL) SELECT r.unid, r.alt, image_id FROM r LEFT JOIN b ON r.unid = b.unid AND r.alt = b.alt WHERE r.unid IS NOT NULL")
def _(spark, base):
    atts = table(spark, base, "doc_attachments")
    refs = atts.where("type = 'image' AND name IS NOT NULL AND unid IS NOT NULL").select("unid", F.col("name").alias("alt")).distinct()
    return attachments.image_sources(atts, refs)


@query("display_names", "SELECT unid, name, arg_max(saved_name, att_id) AS display_name FROM doc_attachments WHERE name IS NOT NULL AND saved_name IS NOT NULL GROUP BY ALL")
def _(spark, base):
    return attachments.display_names(table(spark, base, "doc_attachments"))


@query("sanitized_files", "SELECT att_id, CASE WHEN coalesce(name, '') = '' THEN '_no_name_' WHEN " + _BARE.format("name") + " = '' THEN '_sanitized_' ELSE " + _BARE.format("name") + " END AS safe FROM doc_attachments")
def _(spark, base):
    return table(spark, base, "doc_attachments").select("att_id", fn.sanitize_filename(F.col("name")).alias("safe"))


_STRIP = r"(CASE WHEN regexp_replace({0}, '(\.\d{{3}})+$', '') IN ('', {0}) THEN {1} ELSE regexp_replace({0}, '(\.\d{{3}})+$', '') || {2} END)"


@query("strip_sequences", "SELECT att_id, " + _STRIP.format(_STEM.format("name"), "name", _SUFFIX.format("name")) + " AS stripped FROM doc_attachments")
def _(spark, base):
    return table(spark, base, "doc_attachments").select("att_id", fn.strip_sequence(F.col("name")).alias("stripped"))


_PRETTY = "SELECT att_id, unid, type, " + _STRIP.format(_STEM.format("b"), "b", _SUFFIX.format("b")) + " AS s FROM (SELECT att_id, unid, type, coalesce(nullif(saved_name, ''), nullif(name, ''), 'attachment') AS b FROM doc_attachments)"
_PRETTY2 = "SELECT att_id, unid, CASE WHEN type = 'image' AND " + _SUFFIX.format("c") + " = '' THEN c || '.gif' ELSE c END AS pretty FROM (SELECT att_id, unid, type, " + _BARE.format("s") + " AS c FROM p)"


@query(
    "collision_names",
    f"WITH RECURSIVE p AS ({_PRETTY}), q AS ({_PRETTY2}), r AS (SELECT *, " + _STEM.format("pretty") + " AS st, " + _SUFFIX.format("pretty") + " AS ex, row_number() OVER (PARTITION BY unid ORDER BY att_id) AS n FROM q), "
    "walk AS (SELECT att_id, unid, n, pretty, pretty AS file_name, [pretty] AS taken FROM r WHERE n = 1 UNION ALL SELECT att_id, unid, n, pretty, file_name, list_append(taken, file_name) FROM (SELECT r.att_id, r.unid, r.n, r.pretty, w.taken, CASE WHEN list_contains(w.taken, r.pretty) THEN list_filter(list_transform(range(2, r.n + 2), lambda k: r.st || '_' || k || r.ex), lambda x: NOT list_contains(w.taken, x))[1] ELSE r.pretty END AS file_name FROM walk w JOIN r ON w.unid IS NOT DISTINCT FROM r.unid AND r.n = w.n + 1)) "
    "SELECT att_id, unid, pretty, file_name FROM walk",
)
def _(spark, base):
    return attachments.preferred_name(table(spark, base, "doc_attachments"))


_FOLDER = "files AS (SELECT DISTINCT unid, content_path AS path FROM doc_attachments WHERE content_path IS NOT NULL UNION SELECT DISTINCT unid, 'attachments/' || saved_name FROM doc_attachments WHERE saved_name IS NOT NULL)"


def _folder(spark, base):
    """Files lying in the folders of notes."""
    a = table(spark, base, "doc_attachments")
    return a.where("content_path IS NOT NULL").select("unid", F.col("content_path").alias("path")).union(a.where("saved_name IS NOT NULL").select("unid", F.concat(F.lit("attachments/"), F.col("saved_name")))).distinct()


@query("fuzzy_files", f"WITH {_FOLDER}, a AS (SELECT att_id, unid, lower({_SUFFIX.format('name')}) AS s, regexp_replace(lower({_STEM.format('name')}), '\\s', '', 'g') AS a FROM doc_attachments), f AS (SELECT unid, path, lower({_SUFFIX.format('path')}) AS s, regexp_replace(lower({_STEM.format(chr(114) + 'egexp_extract(path, ' + chr(39) + '([^/]*)$' + chr(39) + ', 1)')}), '\\s', '', 'g') AS f FROM files) SELECT att_id, a.unid, min(path) AS path FROM a JOIN f ON a.unid = f.unid AND a.s = f.s WHERE a <> '' AND f <> '' AND (contains(a, f) OR contains(f, a)) GROUP BY ALL")
def _(spark, base):
    return attachments.fuzzy(table(spark, base, "doc_attachments"), _folder(spark, base))


@query("salvage_union", f"WITH {_FOLDER}, used AS (SELECT unid, content_path AS path FROM doc_attachments WHERE content_path IS NOT NULL) SELECT unid, path, false AS salvaged FROM used UNION ALL SELECT unid, path, true FROM files f WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.unid = f.unid AND u.path = f.path)")
def _(spark, base):
    return attachments.salvaged(table(spark, base, "doc_attachments"), _folder(spark, base))


@query("usable_files", "SELECT att_id, size FROM doc_attachments WHERE size > 0")
def _(spark, base):
    return attachments.usable(table(spark, base, "doc_attachments")).select("att_id", "size")


_ICON = r"CASE WHEN e IN ('xls','xlsx','xlsm','csv') THEN 'excel' WHEN e IN ('ppt','pptx','pptm') THEN 'ppt' WHEN e IN ('doc','docx','docm','rtf') THEN 'word' WHEN e = 'pdf' THEN 'pdf' WHEN e IN ('zip','rar','7z','tar','gz') THEN 'zip' WHEN e IN ('jpg','jpeg','png','gif','bmp') THEN 'image' ELSE 'default' END"


@query("file_icons", r"WITH x AS (SELECT att_id, unid, name, lower(regexp_extract(name, '\.([^.]*)$', 1)) AS e FROM doc_attachments WHERE type = 'file') SELECT att_id, unid, name, " + _ICON + " AS icon, 'attachments/icons/' || " + _ICON + " || '.gif' AS icon_path FROM x")
def _(spark, base):
    return attachments.icons(table(spark, base, "doc_attachments"))


@query("first_per_extension", f"WITH x AS (SELECT lower({_SUFFIX.format('name')}) AS ext, att_id, name FROM doc_attachments) SELECT ext, min(att_id) AS att_id, arg_min(name, att_id) AS name, count(*)::BIGINT AS n FROM x WHERE ext <> '' GROUP BY ext")
def _(spark, base):
    return attachments.first_per_extension(table(spark, base, "doc_attachments"))


@query("size_labels", f"SELECT att_id, {_UNITS.format('size')} AS label FROM doc_attachments WHERE size IS NOT NULL")
def _(spark, base):
    return table(spark, base, "doc_attachments").where("size IS NOT NULL").select("att_id", fn.human_size(F.col("size")).alias("label"))


@query("effective_stamps", "SELECT att_id, coalesce(modified, created) AS stamp FROM doc_attachments")
def _(spark, base):
    return table(spark, base, "doc_attachments").select("att_id", F.coalesce("modified", "created").alias("stamp"))


@query("hash_variants", f"WITH {_FILES} SELECT path, size::INT AS size, sha256(encode(content)[1:1048576]) AS first_sha256, sha256(content) AS sha256 FROM files")
def _(spark, base):
    return dedup.hashes(_files(spark, base)).drop("blake2b")


@query("blake2b_hashes")
def _(spark, base):
    return dedup.hashes(_files(spark, base)).select("path", "blake2b")


@query("known_content", f"WITH {_FILES} SELECT path, sha256(content) AS hash, (size, sha256(content)) IN (SELECT size, sha256(content) FROM files WHERE mtime < TIMESTAMPTZ '2024-01-01 00:00:00+00') AS stored FROM files")
def _(spark, base):
    files = _files(spark, base)
    return dedup.known_content(files, files.where(F.col("mtime") < F.lit("2024-01-01 00:00:00").cast("timestamp")))


@query("fallback_files", f"WITH {_FOLDER}, f AS (SELECT unid, regexp_extract(path, '([^/]*)$', 1) AS n, min(path) AS path FROM files GROUP BY ALL) SELECT att_id, a.unid, coalesce(x.path, y.path) AS path, CASE WHEN x.path IS NOT NULL THEN 'ref_name' ELSE 'name' END AS by FROM doc_attachments a LEFT JOIN f x ON a.unid = x.unid AND a.ref_name = x.n LEFT JOIN f y ON a.unid = y.unid AND a.name = y.n WHERE coalesce(x.path, y.path) IS NOT NULL")
def _(spark, base):
    return attachments.fallback(table(spark, base, "doc_attachments"), _folder(spark, base))


@query("icons_by_path", "WITH k AS (SELECT unid, content_path, arg_max(name, att_id) AS n FROM doc_attachments WHERE type = 'file' AND content_path IS NOT NULL GROUP BY ALL), x AS (SELECT a.att_id, a.unid, a.content_path, a.saved_name AS name, lower(regexp_extract(coalesce(k.n, a.saved_name), '\\.([^.]*)$', 1)) AS e FROM doc_attachments a LEFT JOIN k ON a.unid = k.unid AND a.content_path = k.content_path) SELECT att_id, unid, content_path, name, " + _ICON + " AS icon FROM x")
def _(spark, base):
    a = table(spark, base, "doc_attachments")
    return attachments.icons_by_path(a, a.select("att_id", "unid", "content_path", F.col("saved_name").alias("name"))).select("att_id", "unid", "content_path", "name", "icon")


@query("view_lookup", "SELECT rec_id, unid, form FROM normalized_docs WHERE form = 'Minutes'")
def _(spark, base):
    return scan.lookup(table(spark, base, "normalized_docs").select("rec_id", "unid", "form"), "form", "Minutes")


# Texts


@query("trimmed_leads", "SELECT field_id, regexp_replace(value, '^[ \\x{00A0}\\x{3000}]+', '') AS text FROM doc_fields WHERE value IS NOT NULL")
def _(spark, base):
    return table(spark, base, "doc_fields").where("value IS NOT NULL").select("field_id", fn.trim_lead(F.col("value")).alias("text"))


_MARKUP = "'<p>  </p>' || chr(10) || chr(10) || chr(10) || ' <div>  <span class=\"a\"> </span> <b>' || replace(text, '<', '&lt;') || '</b>   </div> '"


@query("squashed_html", f"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_MARKUP}, '>\\s+<', '><', 'g'), '[ \\t\\f\\x0b\\r]+\\n', chr(10), 'g'), '\\n{{2,}}', chr(10), 'g'), '(?i)<span(?:\\s+[^>]*)?>\\s*</span>', '', 'g'), '(?i)<p(?:\\s+[^>]*)?>\\s*</p>', '', 'g'), '^\\s+|\\s+$', '', 'g') AS html FROM documents WHERE text IS NOT NULL")
def _(spark, base):
    text = F.replace(F.col("text"), F.lit("<"), F.lit("&lt;"))
    markup = F.concat(F.lit("<p>  </p>\n\n\n <div>  <span class=\"a\"> </span> <b>"), text, F.lit("</b>   </div> "))
    return table(spark, base, "documents").where("text IS NOT NULL").select("doc_id", fn.squash_html(markup).alias("html"))


@query("payload_hashes", "SELECT doc_id, sha256(text) AS sha256, length(text)::INT AS n_chars, strlen(text)::INT AS n_bytes FROM documents")
def _(spark, base):
    return table(spark, base, "documents").select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("sha256"), F.length("text").alias("n_chars"), F.octet_length("text").alias("n_bytes"))


@query("base64_round", "SELECT doc_id, base64(encode(text)) AS payload, true AS same FROM documents WHERE text IS NOT NULL")
def _(spark, base):
    payload = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"\s", "")
    return table(spark, base, "documents").where("text IS NOT NULL").select("doc_id", payload.alias("payload"), (F.decode(F.unbase64(payload), "UTF-8") == F.col("text")).alias("same"))


@query("xml_texts", r"SELECT doc_id, length(regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\x{FFFE}\x{FFFF}]', '', 'g'))::INT AS n FROM documents")
def _(spark, base):
    return table(spark, base, "documents").select("doc_id", F.length(fn.xml_text(F.col("text"))).alias("n"))


_HOST = "regexp_extract(server, '^(?:[cC][nN]=)?([^/]+)', 1)"
_URL = f"CASE WHEN coalesce(server, '') <> '' AND coalesce(replica, '') <> '' AND coalesce(unid, '') <> '' THEN 'Notes://' || {_HOST} || '/' || replica || '/' || unid END"


@query("link_urls", f"WITH u AS (SELECT link_id, {_URL} AS url, label FROM link_notes) SELECT link_id, url, 'https://go.example/open?NotesURL=' || url_encode(url) AS redirect, 'https://find.example/s?query=' || url_encode(coalesce(nullif(regexp_extract(label, 'Document\\s+''([^'']+)''', 1), ''), label, '')) AS search FROM u")
def _(spark, base):
    url = fn.notes_url(F.col("server"), F.col("replica"), F.col("unid"))
    return table(spark, base, "link_notes").select("link_id", url.alias("url"), fn.redirect_url(url, "https://go.example/open?NotesURL=").alias("redirect"), fn.search_url(F.col("label"), "https://find.example/s").alias("search"))


@query("markdown_links", r"SELECT link_id, '[' || replace(replace(coalesce(label, raw, ''), '[', '\['), ']', '\]') || '](' || replace(replace(replace(coalesce(raw, '#'), '(', '\('), ')', '\)'), ' ', '%20') || ')' AS md FROM link_notes")
def _(spark, base):
    return table(spark, base, "link_notes").select("link_id", fn.markdown_link(F.col("label"), F.col("raw")).alias("md"))


@query("markdown_cells", r"SELECT field_id, replace(replace(replace(value, '|', '\|'), '`', '\`'), chr(10), '<br>') AS cell FROM doc_fields WHERE value IS NOT NULL")
def _(spark, base):
    return table(spark, base, "doc_fields").where("value IS NOT NULL").select("field_id", fn.markdown_cell(F.col("value")).alias("cell"))


@query("html_escapes", "SELECT field_id, replace(replace(replace(replace(replace(value, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS html FROM doc_fields WHERE value IS NOT NULL")
def _(spark, base):
    return table(spark, base, "doc_fields").where("value IS NOT NULL").select("field_id", fn.escape_html(F.col("value")).alias("html"))


@query("domino_stamps", r"WITH s AS (SELECT rec_id, created, regexp_extract(created, '^\s*(\d{8})T(\d{6})(?:,(\d{1,6}))?(?:([+-])(\d{2})(\d{2})?)?\s*$', ['d', 't', 'f', 's', 'h', 'm']) AS x, regexp_extract(created, '^\s*(\d{8})\s*$', 1) AS b FROM normalized_docs WHERE created IS NOT NULL) SELECT rec_id, CASE WHEN x.d <> '' AND try_strptime(x.d || x.t, '%Y%m%d%H%M%S') IS NOT NULL THEN substr(x.d, 1, 4) || '-' || substr(x.d, 5, 2) || '-' || substr(x.d, 7, 2) || 'T' || substr(x.t, 1, 2) || ':' || substr(x.t, 3, 2) || ':' || substr(x.t, 5, 2) || CASE WHEN regexp_matches(x.f, '[1-9]') THEN '.' || rpad(x.f, 6, '0') ELSE '' END || CASE WHEN x.s <> '' THEN x.s || x.h || ':' || CASE WHEN x.m <> '' THEN x.m ELSE '00' END ELSE '+00:00' END WHEN b <> '' AND try_strptime(b, '%Y%m%d') IS NOT NULL THEN substr(b, 1, 4) || '-' || substr(b, 5, 2) || '-' || substr(b, 7, 2) ELSE created END AS iso FROM s")
def _(spark, base):
    return table(spark, base, "normalized_docs").where("created IS NOT NULL").select("rec_id", fn.domino_stamp(F.col("created")).alias("iso"))


@query("event_props", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, base):
    return table(spark, base, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))
