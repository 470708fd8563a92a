"""Queries over rich text: tokens, rendering, live state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as fn
from folioforge.operators import extraction, tokens
from folioforge.operators.progress import note_key
from folioforge.plans.documents import SQL as _SQL
from folioforge.plans.walk_sql import NODES, TOKENS
from folioforge.render import engine
from folioforge.session import table
from folioforge.sources import dxl, dxl_writer, files
from folioforge.streaming import progress_state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"stream_progress": _SQL["progress_latest"]}


def _of(name: str, f: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, base: f(tokens.tokens(table(spark, base, "raw_records")))


_of("token_counts", tokens.counts)
_of("token_text", tokens.plain_text)
_of("token_first_link", lambda t: tokens.first(t, "link"))
_of("token_merge", tokens.merged)
_of("token_paragraphs", tokens.paragraphs)
_of("token_lists", tokens.list_items)
_of("token_images", tokens.images)
_of("token_indents", tokens.indents)
_of("token_styles", tokens.run_styles)
_of("token_links", tokens.links)
QUERIES["table_widths"] = lambda spark, base: tokens.table_widths(table(spark, base, "raw_records"))
QUERIES["table_grid"] = lambda spark, base: tokens.grid(table(spark, base, "raw_records"))
QUERIES["cell_attributes"] = lambda spark, base: tokens.cell_attributes(table(spark, base, "raw_records"))

_W = "(PARTITION BY record_id, parent_path, slot ORDER BY dewey)"
_INCHES = r"CASE WHEN ends_with({0}, 'in') THEN {1} WHEN ends_with({0}, 'pt') THEN {1} / 72.0 ELSE 0 END"
_INDENT = "CASE WHEN {0} >= 1.75 THEN 'indent-3' WHEN {0} >= 1.25 THEN 'indent-2' WHEN {0} >= 0.75 THEN 'indent-1' ELSE '' END"


def _indent_of(margin: str) -> str:
    number = rf"try_cast(regexp_extract({margin}, '^\s*([0-9.]+)\s*(?:in|pt)?\s*$', 1) AS DOUBLE)"
    return _INDENT.format("(" + _INCHES.format(margin, number) + ")")


_LISTED = "CASE v ->> '$.a.list.type' WHEN 'number' THEN '1' WHEN 'alphaupper' THEN 'A' WHEN 'alphalower' THEN 'a' WHEN 'romanupper' THEN 'I' WHEN 'romanlower' THEN 'i' END"
_SPACE = "try_cast(v ->> '$.a.spaceafter' AS DOUBLE)"
_SPAN = "CASE WHEN try_cast({1} AS INT) > 1 THEN '{0}=\"' || try_cast({1} AS INT) || '\"' END"
SQL |= {
    "token_counts": TOKENS + "SELECT record_id, t, count(*)::BIGINT AS n FROM toks GROUP BY record_id, t",
    "token_first_link": TOKENS + "SELECT record_id, node_path, text, label, name, alt FROM toks WHERE t = 'link' QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY dewey, node_path) = 1",
    "token_text": TOKENS + r""", pieces AS (SELECT *, CASE t WHEN 'text' THEN text WHEN 'link' THEN label WHEN 'par' THEN chr(10) WHEN 'br' THEN chr(10) WHEN 'attachmentref' THEN '[' || displayname || ']' WHEN 'img' THEN '[Image: ' || alt || ']' WHEN 'hr' THEN chr(10) || '---' || chr(10) END AS piece FROM toks)
  SELECT record_id, field, regexp_replace(string_agg(piece, '' ORDER BY dewey, node_path), '^\n+|\s+$', '', 'g') AS text FROM pieces WHERE piece IS NOT NULL GROUP BY record_id, field""",
    "token_merge": TOKENS + f""", own AS (SELECT *, sum(CASE WHEN t = 'text' AND coalesce(lt = t AND ls = coalesce(s, '') AND la = coalesce(a, ''), false) THEN 0 ELSE 1 END) OVER {_W} AS isle FROM (SELECT *, lag(t) OVER {_W} AS lt, lag(coalesce(s, '')) OVER {_W} AS ls, lag(coalesce(a, '')) OVER {_W} AS la FROM toks))
  SELECT record_id, parent_path, slot, s, a, min(node_path) AS node_path, count(*)::BIGINT AS n, coalesce(string_agg(text, '' ORDER BY dewey), '') AS text FROM own WHERE t = 'text' GROUP BY record_id, parent_path, slot, isle, s, a""",
    "token_paragraphs": TOKENS + f"""SELECT record_id, node_path, again, concat_ws(' ', CASE WHEN v ->> '$.a.align' IN ('left', 'center', 'right', 'justify') THEN 'text-align: ' || (v ->> '$.a.align') || ';' WHEN v ->> '$.a.align' = 'full' THEN 'text-align: justify;' END, CASE WHEN {_SPACE} <> 0 THEN 'margin-bottom: ' || round(greatest({_SPACE} - 1, 0) * 0.8, 4) || 'em;' END) AS css,
  {_indent_of("coalesce(v ->> '$.a.leftmargin', '')")} AS indent, v ->> '$.a.list.type' AS list, {_LISTED} AS ol_type
  FROM (SELECT *, coalesce(lag(t) OVER {_W} = 'par' AND coalesce(lag(a) OVER {_W}, '') = coalesce(a, ''), false) AS again FROM toks) WHERE t = 'par'""",
    "token_lists": TOKENS + f"""SELECT record_id, node_path, kind, list_no::BIGINT AS list_no, item::INT AS item FROM (SELECT *, row_number() OVER (PARTITION BY record_id, parent_path, slot, list_no ORDER BY dewey) AS item FROM (
  SELECT *, sum(CASE WHEN before = kind THEN 0 ELSE 1 END) OVER {_W} AS list_no FROM (SELECT *, lag(kind) OVER {_W} AS before FROM (SELECT *, coalesce(v ->> '$.a.list.type', '') AS kind FROM toks WHERE t = 'par')))) WHERE kind <> ''""",
    "token_images": TOKENS + "SELECT record_id, node_path, alt, (row_number() OVER (PARTITION BY record_id ORDER BY dewey) - 1)::INT AS seq FROM toks WHERE t = 'img'",
    "token_indents": TOKENS + f"""SELECT record_id, node_path, t, indent FROM (SELECT *, coalesce(last_value(nullif(own, '') IGNORE NULLS) OVER (PARTITION BY record_id, parent_path, slot ORDER BY dewey ROWS UNBOUNDED PRECEDING), '') AS indent FROM (SELECT *, CASE WHEN t = 'par' THEN {_indent_of("coalesce(v ->> '$.a.leftmargin', '')")} END AS own FROM toks)) WHERE t IS DISTINCT FROM 'par' AND t IS NOT NULL""",
    "token_styles": TOKENS + r"""SELECT record_id, node_path, concat_ws(' ', CASE WHEN list_has_any(f, ['b']) THEN 'strong' END, CASE WHEN list_has_any(f, ['i']) THEN 'em' END, CASE WHEN list_has_any(f, ['u']) THEN 'u' END, CASE WHEN list_has_any(f, ['s', 'strike']) THEN 's' END, CASE v ->> '$.a.script' WHEN 'super' THEN 'sup' WHEN 'sub' THEN 'sub' END) AS tags,
  concat_ws(' ', 'color: ' || nullif(v ->> '$.a.color', '') || ';', 'background-color: ' || nullif(v ->> '$.a.bgcolor', '') || ';', 'font-size: ' || nullif(v ->> '$.a.size', '') || ';') AS css,
  CASE WHEN regexp_full_match(v ->> '$.a.color', '#[0-9A-Fa-f]{6}') THEN [('0x' || substr(v ->> '$.a.color', 2, 2))::INT, ('0x' || substr(v ->> '$.a.color', 4, 2))::INT, ('0x' || substr(v ->> '$.a.color', 6, 2))::INT] END AS rgb
  FROM (SELECT *, coalesce(try_cast(s AS JSON)::VARCHAR[], []) AS f FROM toks WHERE t IN ('text', 'link'))""",
    "token_links": TOKENS + "SELECT record_id, node_path, kind, href, label FROM (SELECT *, CASE WHEN v ->> '$.a.notes.unid' IS NOT NULL THEN 'notes' WHEN regexp_matches(lower(href), '^https?://') THEN 'http' END AS kind FROM toks WHERE t = 'link') WHERE kind IS NOT NULL",
    "table_widths": NODES + r"""SELECT record_id, regexp_replace(row_path, '\.rows\[\d+\]$', '') AS table_path, count(*)::BIGINT AS n_rows, max(width)::BIGINT AS n_columns FROM (SELECT record_id, parent_path AS row_path, sum(coalesce(try_cast(v ->> '$.colspan' AS INT), 1)) AS width FROM nodes WHERE ends_with("table", '.cells') GROUP BY ALL) GROUP BY ALL""",
    "table_grid": NODES + r""", cells AS (SELECT record_id, regexp_replace(node_path, '\.rows\[\d+\]\.cells\[\d+\]$', '') AS table_path, dewey[-2] AS r, greatest(coalesce(try_cast(v ->> '$.colspan' AS INT), 1), 1) AS cs, greatest(coalesce(try_cast(v ->> '$.rowspan' AS INT), 1), 1) AS rs, node_path, dewey[-1] AS c FROM nodes WHERE ends_with("table", '.cells')),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY record_id, table_path ORDER BY r, c) AS k FROM cells),
  placed AS (
    SELECT record_id, table_path, k, r, node_path, 0::BIGINT AS col, cs::BIGINT AS after, flatten(list_transform(range(rs), lambda i: list_transform(range(cs), lambda j: (r + i) * 100000 + j))) AS taken FROM numbered WHERE k = 1
    UNION ALL
    SELECT record_id, table_path, k, r, node_path, col, col + cs, list_concat(taken, flatten(list_transform(range(rs), lambda i: list_transform(range(cs), lambda j: (r + i) * 100000 + col + j)))) FROM (
      SELECT n.*, p.taken, list_filter(list_transform(range(len(p.taken) + 1), lambda x: x + CASE WHEN n.r = p.r THEN p.after ELSE 0 END), lambda x: NOT list_contains(p.taken, n.r * 100000 + x))[1] AS col FROM placed p JOIN numbered n ON p.record_id = n.record_id AND p.table_path = n.table_path AND n.k = p.k + 1))
  SELECT record_id, table_path, r::INT AS "row", col::INT AS col, node_path FROM placed""",
    "cell_attributes": NODES + "SELECT record_id, node_path, concat_ws(' ', " + _SPAN.format("colspan", "coalesce(v ->> '$.colspan', v ->> '$.columnspan')") + ", " + _SPAN.format("rowspan", "v ->> '$.rowspan'") + """, 'style="background-color: ' || nullif(coalesce(v ->> '$.style.bgcolor', v ->> '$.style.style.bgcolor'), '') || ';"') AS attributes FROM nodes WHERE ends_with("table", '.cells')""",
}

QUERIES["render_documents"] = lambda spark, base: engine.render(table(spark, base, "raw_records"), ("html", "md"))
QUERIES["stream_progress"] = lambda spark, base: progress_state.snapshot(spark, f"{base}/progress_log.parquet")


QUERIES["render_files"] = lambda spark, base: engine.render_files(table(spark, base, "raw_records"), ("docx", "pdf")).select("record_id", "format", F.length("content").alias("size"), "error")


def _notes_xml(spark: SparkSession, base: str) -> DataFrame:
    """The items of every note as exported XML: what an export of these notes would hold."""
    f = table(spark, base, "doc_fields")
    esc = lambda c: fn.escape_html(fn.xml_text(c))
    rich = F.col("type") == "richtext"
    listed = F.concat(F.lit("<textlist>"), F.array_join(F.transform("value_list", lambda x: F.concat(F.lit("<text>"), esc(x), F.lit("</text>"))), ""), F.lit("</textlist>"))
    body = F.when(rich, F.concat(F.lit("<richtext><par>"), F.replace(esc(F.col("value")), F.lit("\n"), F.lit("</par><par>")), F.lit("</par></richtext>"))).when(F.col("value_list").isNotNull(), listed).otherwise(F.concat(F.lit("<text>"), esc(F.col("value")), F.lit("</text>")))
    item = F.concat(F.lit("<item name='"), F.col("name"), F.lit("'>"), F.coalesce(body, F.lit("")), F.lit("</item>"))
    key = note_key(F.col("unid"))
    notes = f.where("unid IS NOT NULL").groupBy(key.alias("unid"), "replica", "db_title").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "field_id", item.alias("x")))), lambda x: x["x"]), "").alias("items"))
    xml = F.concat(F.lit("<note><noteinfo unid='"), "unid", F.lit("'/>"), "items", F.lit("</note>"))
    return notes.select(F.concat_ws("/", "replica", "unid").alias("path"), "db_title", xml.alias("xml"))


def _dxl_notes(spark: SparkSession, base: str) -> DataFrame:
    parsed = dxl.normalise(_notes_xml(spark, base))
    return parsed.select("path", "unid", "error", F.get_json_object("payload", "$.fields.Subject.value").alias("subject"), F.get_json_object("payload", "$.fields.Body.text").alias("body"))


QUERIES["dxl_notes"] = _dxl_notes
_BLANKS = r"[\s\x{3000}\x{00A0}\x{0085}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x1c-\x1f]+"
# The last subject with a text counts; paragraphs are lines, blanks in them single and their ends trimmed; bodies are joined.
SQL["dxl_notes"] = rf"""WITH f AS (SELECT upper(trim(unid)) AS unid, replica, db_title, name, type, ord, field_id, regexp_replace(value, '[\x00-\x08\x0b\x0c\x0e-\x1f\x{{FFFE}}\x{{FFFF}}]', '', 'g') AS value, value_list FROM doc_fields WHERE unid IS NOT NULL),
lines AS (SELECT unid, replica, db_title, ord, field_id, array_to_string(list_filter(list_transform(string_split(coalesce(value, ''), chr(10)), lambda l: regexp_replace(ltrim(regexp_replace(l, '[ \t\r\n]+', ' ', 'g'), ' '), '{_BLANKS}$', '')), lambda l: l <> ''), chr(10)) AS text FROM f WHERE name = 'Body' AND type = 'richtext'),
bodies AS (SELECT unid, replica, db_title, string_agg(text, chr(10) ORDER BY ord, field_id) AS body FROM lines GROUP BY ALL),
subjects AS (SELECT unid, replica, db_title, arg_max(subject, (ord, field_id)) AS subject FROM (SELECT *, regexp_replace(regexp_replace(value, '{_BLANKS}$', ''), '^{_BLANKS}', '') AS subject FROM f WHERE name = 'Subject') WHERE subject <> '' GROUP BY ALL)
SELECT replica || '/' || n.unid AS path, n.unid, NULL::VARCHAR AS error, subject, body FROM (SELECT DISTINCT unid, replica, db_title FROM f) n LEFT JOIN bodies USING (unid, replica, db_title) LEFT JOIN subjects USING (unid, replica, db_title)"""


def _exported(spark: SparkSession, base: str) -> DataFrame:
    """The nested records as exported XML, with fonts, tables, sections, links and pictures; unreadable ones broken."""
    return dxl_writer.export(table(spark, base, "raw_records"))


def _dxl_report(spark: SparkSession, base: str) -> DataFrame:
    parsed = dxl.normalise(_exported(spark, base))
    broken = F.get_json_object("payload", "$.meta.error").isNotNull()
    return parsed.groupBy("db_title").agg(F.count_if(~broken).alias("n_ok"), F.count_if(broken).alias("n_failed"), F.sum(F.coalesce(F.json_array_length(F.get_json_object("payload", "$.links.http")), F.lit(0)).cast("long")).alias("n_links"))


QUERIES["dxl_report"] = _dxl_report
SQL["dxl_report"] = TOKENS + """SELECT db_title, count(*) FILTER (ok)::BIGINT AS n_ok, count(*) FILTER (NOT ok)::BIGINT AS n_failed, sum(n)::BIGINT AS n_links FROM (
  SELECT db_title, coalesce(json_type(t.j) = 'OBJECT', false) AS ok, (SELECT count(*) FROM toks k WHERE k.record_id = r.record_id AND k.t = 'link' AND starts_with(k.node_path, 'fields.Body.') AND regexp_matches(lower(trim(k.href)), '^https?://')) AS n FROM raw_records r LEFT JOIN texts t ON r.record_id = t.record_id) GROUP BY db_title"""

_KINDS = ("link", "table", "section", "img", "attachmentref", "hr", "br")


def _dxl_tokens(spark: SparkSession, base: str) -> DataFrame:
    """Tokens of each kind after a way through XML and back."""
    parsed = dxl.normalise(_exported(spark, base)).select(F.col("path").cast("long").alias("record_id"), "payload")
    return tokens.counts(tokens.tokens(parsed).where(F.col("t").isin(*_KINDS)))


QUERIES["dxl_tokens"] = _dxl_tokens
SQL["dxl_tokens"] = TOKENS + f"SELECT record_id, t, count(*)::BIGINT AS n FROM toks WHERE t IN {_KINDS} AND starts_with(node_path, 'fields.Body.') GROUP BY record_id, t"


def _dxl_cells(spark: SparkSession, base: str) -> DataFrame:
    """Rows and widths of the tables after a way through XML and back, counted by their shape."""
    parsed = dxl.normalise(_exported(spark, base)).select(F.col("path").cast("long").alias("record_id"), "payload")
    return tokens.table_widths(parsed).groupBy("record_id", "n_rows", "n_columns").agg(F.count("*").alias("n"))


QUERIES["dxl_cells"] = _dxl_cells
SQL["dxl_cells"] = f"SELECT record_id, n_rows, n_columns, count(*)::BIGINT AS n FROM ({SQL['table_widths']}) WHERE starts_with(table_path, 'fields.Body.') GROUP BY ALL"


def _dxl_styles(spark: SparkSession, base: str) -> DataFrame:
    """Flags and colours of the texts after a way through XML and back: characters of each style."""
    parsed = dxl.normalise(_exported(spark, base)).select(F.col("path").cast("long").alias("record_id"), "payload")
    own = tokens.tokens(parsed).where("t = 'text'").withColumn("bare", F.regexp_replace("text", r"\s", ""))
    flags = F.array_join(F.array_sort(F.coalesce(F.from_json("s", "array<string>"), F.array().cast("array<string>"))), ",")
    return own.groupBy("record_id", flags.alias("flags"), F.coalesce(F.get_json_object("a", "$.color"), F.lit("")).alias("color")).agg(F.sum(F.length("bare")).alias("n_chars"))


QUERIES["dxl_styles"] = _dxl_styles
SQL["dxl_styles"] = TOKENS + r"""SELECT record_id, array_to_string(list_sort(coalesce(try_cast(s AS JSON)::VARCHAR[], [])), ',') AS flags, coalesce(v ->> '$.a.color', '') AS color, sum(length(regexp_replace(text, '\s', '', 'g')))::BIGINT AS n_chars FROM toks
  WHERE t = 'text' AND starts_with(node_path, 'fields.Body.') AND regexp_replace(text, '\s', '', 'g') <> '' GROUP BY ALL"""


def _notes_with_files(spark: SparkSession, base: str) -> DataFrame:
    """The attachments of every note as exported XML: files whose content is their name, and inline pictures."""
    a = table(spark, base, "doc_attachments").where("unid IS NOT NULL AND name IS NOT NULL")
    name = F.replace(fn.escape_html(fn.xml_text(F.col("name"))), F.lit("&#39;"), F.lit("&apos;"))
    data = F.when(F.col("size") > 0, F.base64(F.encode("name", "UTF-8"))).otherwise("")
    file = F.concat(F.lit("<item name='$FILE'><object><file name='"), name, F.lit("' size='"), F.col("size").cast("string"), F.lit("'><filedata>"), data, F.lit("</filedata></file></object></item>"))
    ref = F.concat(F.lit("<attachmentref name='"), name, F.lit("'/>"))
    picture = F.concat(F.lit("<picture width='1px' height='1px'><gif>"), data, F.lit("</gif></picture>"))
    is_file = F.col("type") == "file"
    gathered = lambda x: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("att_id", x.alias("x")))), lambda y: y["x"]), "")
    each = a.groupBy(note_key(F.col("unid")).alias("unid")).agg(gathered(F.when(is_file, file).otherwise("")).alias("items"), gathered(F.when(is_file, ref).otherwise(picture)).alias("refs"))
    xml = F.concat(F.lit("<note><noteinfo unid='"), "unid", F.lit("'/>"), "items", F.lit("<item name='Body'><richtext><par>"), "refs", F.lit("</par></richtext></item></note>"))
    return each.select(F.col("unid").alias("path"), F.lit("").alias("db_title"), xml.alias("xml"))


def _extract(spark: SparkSession, base: str) -> DataFrame:
    return extraction.extract(_notes_with_files(spark, base)).select("path", "name", "type", "sha256", "size")


QUERIES["extract_files"] = _extract
# Of files with one name the first with a content counts; pictures are numbered through their note.
SQL["extract_files"] = """WITH a AS (SELECT *, upper(trim(unid)) AS path FROM doc_attachments WHERE unid IS NOT NULL AND name IS NOT NULL)
SELECT DISTINCT path, name, 'file' AS type, max(CASE WHEN size > 0 THEN sha256(name) END) OVER w AS sha256, max(CASE WHEN size > 0 THEN strlen(name) ELSE 0 END) OVER w AS size FROM a WHERE type = 'file' WINDOW w AS (PARTITION BY path, name)
UNION ALL SELECT path, 'inline_image_' || (row_number() OVER (PARTITION BY path ORDER BY att_id) - 1), 'image', CASE WHEN size > 0 THEN sha256(name) END, CASE WHEN size > 0 THEN strlen(name) ELSE 0 END FROM a WHERE type <> 'file'"""


def _extracted_names(spark: SparkSession, base: str) -> DataFrame:
    """Whether the names that files are written under are unique in their note, and how many were given a number."""
    files_ = extraction.extract(_notes_with_files(spark, base))
    return files_.groupBy("path").agg(F.count("*").alias("n_files"), F.countDistinct("file_name").alias("n_names"))


QUERIES["extracted_names"] = _extracted_names
SQL["extracted_names"] = """WITH a AS (SELECT *, upper(trim(unid)) AS path FROM doc_attachments WHERE unid IS NOT NULL AND name IS NOT NULL), n AS (SELECT path, count(DISTINCT CASE WHEN type = 'file' THEN name END) + count(*) FILTER (type <> 'file') AS n FROM a GROUP BY path)
SELECT path, n::BIGINT AS n_files, n::BIGINT AS n_names FROM n"""


def _file_references(spark: SparkSession, base: str) -> DataFrame:
    notes = _notes_with_files(spark, base)
    return extraction.references(notes, extraction.extract(notes))


QUERIES["file_references"] = _file_references


def _empty_folders(spark: SparkSession, base: str) -> DataFrame:
    a = table(spark, base, "doc_attachments").where("unid IS NOT NULL")
    folders = a.select(F.concat_ws("/", F.lit("out"), note_key(F.col("unid"))).alias("path")).distinct()
    files_ = a.where("content_path IS NOT NULL").select(F.concat_ws("/", F.lit("out"), note_key(F.col("unid")), "content_path").alias("path"))
    return extraction.empty_folders(folders, files_)


QUERIES["empty_folders"] = _empty_folders
SQL["empty_folders"] = "SELECT 'out/' || upper(trim(unid)) AS path FROM doc_attachments WHERE unid IS NOT NULL GROUP BY 1 HAVING count(content_path) = 0"


def _log_lines(spark: SparkSession, base: str) -> DataFrame:
    log = table(spark, base, "progress_log")
    raw = log.select("line_no", F.to_json(F.struct("ts", "db", "unid", "status", F.col("try_no").alias("try"), "err", F.col("out_path").alias("out"))).alias("value"))
    broken = log.select("line_no", F.lit("{\"ts\": ").alias("value"))
    return files.parse_lines(raw.union(broken))


QUERIES["progress_lines"] = _log_lines
SQL["progress_lines"] = "SELECT line_no, ts, db, unid, status, try_no, err, out_path FROM progress_log WHERE unid IS NOT NULL"


def _indent(spark: SparkSession, base: str) -> DataFrame:
    size = F.concat((F.col("p_size") / 20).cast("decimal(6,2)").cast("string"), F.lit("in"))
    return table(spark, base, "part").select("p_partkey", fn.indent_class(size).alias("indent"), fn.points(size).alias("points"))


QUERIES["indent_classes"] = _indent
SQL["indent_classes"] = "WITH x AS (SELECT p_partkey, (p_size / 20.0)::DECIMAL(6,2)::DOUBLE AS i FROM part) SELECT p_partkey, CASE WHEN i >= 1.75 THEN 'indent-3' WHEN i >= 1.25 THEN 'indent-2' WHEN i >= 0.75 THEN 'indent-1' ELSE '' END AS indent, i * 72 AS points FROM x"


def _styles(spark: SparkSession, base: str) -> DataFrame:
    f = table(spark, base, "doc_fields").where("value IS NOT NULL")
    styles = F.array_compact(F.array(F.when(F.col("ord") % 2 == 0, "b"), F.when(F.col("field_id") % 3 == 0, "i"), F.when(F.col("field_id") % 5 == 0, "s"), F.when(F.col("field_id") % 7 == 0, "mono")))
    return f.select("field_id", fn.decorate(F.col("value"), styles).alias("md"), F.array_join(fn.merge_styles(styles, F.array(F.lit("u"), F.lit("b"))), ",").alias("merged"), fn.backticks(F.col("value")).alias("ticks"))


QUERIES["markdown_styles"] = _styles
SQL["markdown_styles"] = r"""WITH x AS (SELECT field_id, value, ord % 2 = 0 AS b, field_id % 3 = 0 AS i, field_id % 5 = 0 AS s, field_id % 7 = 0 AS m, coalesce(list_max(list_transform(regexp_extract_all(value, '`+'), lambda t: length(t))), 0) AS n FROM doc_fields WHERE value IS NOT NULL),
y AS (SELECT *, CASE WHEN m THEN repeat('`', n + 1) || CASE WHEN starts_with(value, '`') OR ends_with(value, '`') THEN ' ' ELSE '' END || value || CASE WHEN starts_with(value, '`') OR ends_with(value, '`') THEN ' ' ELSE '' END || repeat('`', n + 1) ELSE value END AS c FROM x),
z AS (SELECT *, CASE WHEN s THEN '~~' || c || '~~' ELSE c END AS d FROM y), w AS (SELECT *, CASE WHEN i THEN '*' || d || '*' ELSE d END AS e FROM z)
SELECT field_id, CASE WHEN b THEN '**' || e || '**' ELSE e END AS md, 'b' || CASE WHEN i THEN ',i' ELSE '' END || CASE WHEN m THEN ',mono' ELSE '' END || CASE WHEN s THEN ',s' ELSE '' END || ',u' AS merged, n::INT AS ticks FROM w"""
