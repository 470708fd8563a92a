"""Small cases of the document operators: text functions, XML notes, renderers, tokens, duplicates, sinks."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge.functions import text as fn
from folioforge.operators import attachments, dedup, progress, scan, tokens
from folioforge.render import engine
from folioforge.sources import dxl, files, sinks
from folioforge.streaming import progress_state

NOTE = """<?xml version="1.0"?><note xmlns="http://example.org/dxl" form="Memo"><noteinfo unid="ABC"><created><datetime>20251023T101112,34+09</datetime></created></noteinfo>
<item name="Subject"><text>Hello | there</text></item><item name="N"><number>5</number></item><item name="$X"><text>no</text></item><item name="Form"><text>Memo</text></item>
<item name="Tags"><textlist><text>a</text><text/><text>b</text></textlist></item><item name="When"><datetimelist><datetime>20250101</datetime></datetimelist></item>
<item name="$FILE"><object><file name="d.txt" size="x"><filedata>aGVsbG8=</filedata></file></object></item>
<item name="Body"><richtext><pardef id="1" align="full" leftmargin="1in"/><pardef id="2" list="number"/>
<par def="1"><run><font color="red" style="bold"/>Hello </run><run>b<b> x</b> y</run></par><par def="1"/><par def="1">z<br/>w</par><par def="2">one</par><par def="2">two</par>
<table><tablecolumn width="1in"/><tablerow><tablecell colspan="2" bgcolor="lime"><par>c1 <picture width="2px" height="3px"><gif>R0lG</gif></picture></par></tablecell></tablerow><tablerow><tablecell rowspan="2"><par>a</par></tablecell><tablecell><par>b</par></tablecell></tablerow><tablerow><tablecell><par>c</par></tablecell></tablerow></table>
<section expanded="true"><sectiontitle>T</sectiontitle>tail<par>body<attachmentref name="d.txt" displayname="D.txt"><picture width="1px" height="1px"><gif>R0lG</gif></picture></attachmentref></par></section>
<par><urllink href="https://a.example"><run>lab<b>el</b></run></urllink><doclink server="CN=S/O=V" database="R" document="U" description="dd"/></par><horizrule/></richtext></item></note>"""


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v"))).collect()[0][0]


@pytest.mark.parametrize(("f", "value", "want"), [
    (fn.safe_name, "a:b  c__d. ", "a_b_c_d"), (fn.safe_name, None, "NoName"), (fn.safe_name, "...", "_sanitized_"), (fn.safe_name, "x" * 80, "x" * 50),
    (fn.sanitize_filename, "a b.txt", "a_b.txt"), (fn.sanitize_filename, "y" * 300 + ".txt", "y" * 196 + ".txt"), (fn.sanitize_filename, "", "_no_name_"),
    (fn.strip_sequence, "a_v4.1.4.002.002.md", "a_v4.1.4.md"), (fn.strip_sequence, ".001.txt", ".001.txt"), (fn.strip_sequence, "x.txt", "x.txt"),
    (fn.icon_class, "A.XLSX", "excel"), (fn.icon_class, "noext", "default"), (fn.percent_encode, "a b*~é", "a%20b%2A~%C3%A9"), (fn.indent_class, "1in", "indent-1"), (fn.indent_class, "126pt", "indent-3"), (fn.indent_class, "x", ""),
    (fn.iso_day, "2023-10-09T08:35:17+09:00", "20231009"), (fn.iso_day, "2023-13-09", "INVALIDDATE"), (fn.iso_day, None, "NODATE"),
    (fn.domino_stamp, "20251023T101112,34+09", "2025-10-23T10:11:12.340000+09:00"), (fn.domino_stamp, "20251023T101112-0530", "2025-10-23T10:11:12-05:30"), (fn.domino_stamp, "20251023", "2025-10-23"), (fn.domino_stamp, "20251323T101112", "20251323T101112"),
    (fn.squash_html, "<p> </p><b>x</b>  <i>y</i>\n\n", "<b>x</b><i>y</i>"), (fn.xml_text, "a\x00b\tc", "ab\tc"), (fn.markdown_code, "a``b", "```a``b```"), (fn.trim_lead, "　 x", "x"), (fn.link_query, "View 'a', Document 'b c'", "b c"),
])
def test_text(spark, f, value, want):
    assert one(spark, value, f) == want


def test_sizes_and_colours(spark):
    assert [one(spark, n, fn.human_size, "long") for n in (0, 1023, 1536, 2560, 5 * 1024**4)] == ["0 B", "1023 B", "2 KB", "2 KB", "5 TB"]
    assert one(spark, "#0a10FF", fn.rgb) == [10, 16, 255] and one(spark, "red", fn.rgb) is None
    assert [one(spark, n, fn.copylike) for n in ("a (1).txt", "a_2.txt", "a.txt", "Copy.txt")] == [True, True, False, True]
    assert one(spark, "a/../../b", lambda c: scan.inside(c, "a")) is False and one(spark, "a/./b", lambda c: scan.inside(c, "a")) is True and one(spark, "ab/c", lambda c: scan.inside(c, "a")) is False


def test_note_xml():
    doc, payloads = dxl.parse(NOTE, "DB")
    assert doc["meta"] | {"unid": "ABC", "form": "Memo", "created": "2025-10-23T10:11:12.340000+09:00"} == doc["meta"]
    assert {k: (v["type"], v.get("value")) for k, v in doc["fields"].items() if k != "Body"} == {"Subject": ("text", "Hello | there"), "N": ("number", "5"), "Tags": ("textlist", ["a", "b"]), "When": ("datetimelist", ["2025-01-01"])}
    runs = doc["fields"]["Body"]["runs"]
    assert [r["t"] for r in runs] == ["par", "text", "text", "text", "text", "par", "text", "br", "text", "par", "text", "par", "text", "table", "section", "par", "link", "link", "hr"]
    assert runs[1] == {"t": "text", "text": "Hello ", "s": ["b"], "a": {"color": "red"}} and runs[3]["text"] == " x"
    assert runs[13]["rows"][0]["cells"][0] | {"colspan": 2, "style": {"bgcolor": "lime"}} == runs[13]["rows"][0]["cells"][0]
    assert runs[14]["title_runs"][-1]["text"] == "T" and [r["t"] for r in runs[14]["body_runs"]] == ["par", "text", "par", "text", "attachmentref"]
    assert [(a["name"], a["size"]) for a in doc["attachments"]] == [("d.txt", 0), ("inline_image_0", 3)]
    assert [p["content"] for p in payloads] == [b"hello", b"GIF"[:3]] or payloads[0]["content"] == b"hello"
    assert doc["links"]["http"][0]["raw"] == "https://a.example" and doc["links"]["notes"][0]["unid"] == "U"
    assert dxl.parse("<a><b", "DB")[0]["meta"]["error"].startswith("ParseError") and dxl.parse("", "DB")[0]["meta"]["error"]
    assert dxl.parse("<note><item name='A'><text>x\x01y</text></item></note>", "DB")[0]["fields"]["A"]["value"] == "xy"


def test_style_law():
    a, b = {"s": ["u"], "a": {"color": "red", "fx": ["x"]}}, {"s": ["b"], "a": {"color": "blue", "fx": ["y", "x"]}}
    assert dxl.merge_style(a, b) == {"s": ["b", "u"], "a": {"color": "blue", "fx": ["x", "y"]}}
    assert dxl.merge_style(a, a) == a and dxl.merge_style({}, {}) == {}


def test_tokens_and_rendering(spark):
    doc, _ = dxl.parse(NOTE, "DB")
    records = spark.createDataFrame([(1, json.dumps(doc)), (2, "no json"), (3, json.dumps({"meta": {"error": "x<y"}, "fields": {}}))], "record_id long, payload string")
    toks = tokens.tokens(records)
    assert {(r["t"], r["n"]) for r in tokens.counts(toks).collect()} >= {("link", 2), ("img", 1), ("attachmentref", 1), ("table", 1), ("section", 1), ("hr", 1)}
    assert {r["item"] for r in tokens.list_items(toks).collect()} == {1, 2}
    assert tokens.images(toks).collect()[0]["seq"] == 0
    assert [(r["n_rows"], r["n_columns"]) for r in tokens.table_widths(records).collect()] == [(3, 2)]
    assert {(r["row"], r["col"]) for r in tokens.grid(records).collect()} == {(0, 0), (1, 0), (1, 1), (2, 1)}
    out = {(r["record_id"], r["format"]): r for r in engine.render(records, ("html", "md")).collect()}
    html = out[1, "html"]["output"]
    for part in ("<h1>Hello | there</h1>", "<strong>", '<ol type="1"><li>one</li><li>two</li></ol>', 'colspan="2"', "<details open><summary>T</summary>", 'href="https://a.example"', "<hr>", "Appendix", 'class="indent-1"', "Notes://S/R/U"):
        assert part in html, part
    assert "# Hello | there" in out[1, "md"]["output"] and "| --- |" in out[1, "md"]["output"] and "[label](https://a.example)" in out[1, "md"]["output"]
    assert out[2, "html"]["error"] == "no document" and "x&lt;y" in out[3, "html"]["output"]


def test_duplicates(spark):
    rows = [("d/a.txt", 3, b"abc"), ("d/a (1).txt", 3, b"abc"), ("d/b.txt", 3, b"xyz"), ("e/aa.txt", 3, b"abc"), ("d/n.txt", 3, None)]
    df = spark.createDataFrame(rows, "path string, size long, content binary").withColumn("mtime", F.lit("2024-01-01").cast("timestamp"))
    got = {(r["path"], r["action"]) for r in dedup.report(df).collect()}
    assert got == {("d/a.txt", "keep"), ("e/aa.txt", "delete"), ("d/a (1).txt", "delete")}
    groups = df.select("path", "size")
    assert [(r["path"], r["group_no"]) for r in dedup.numbered(groups, ["path"]).orderBy("group_no").collect()] == [(p, i) for i, p in enumerate(sorted(r[0] for r in rows), 1)]
    assert dedup.report(df.limit(0)).count() == 0


def test_progress(spark, tmp_path):
    cols = "line_no long, ts string, db string, unid string, status string, try_no int, err string, out_path string"
    log = spark.createDataFrame([(1, "t", "D", "a", "processing", 1, None, None), (2, "t", "D", "A", "error", 1, "x", None), (3, "t", "D", "b", "done", 1, None, "o"), (4, "t", "D", "c", "error", 3, "y", None), (5, "t", None, "d", "done", 1, None, None), (3, "t", "D", "b", "done", 1, None, "o")], cols)
    assert {(r["unid"], r["status"]) for r in progress.latest(log).collect()} == {("A", "error"), ("B", "done"), ("C", "error")}
    cand = spark.createDataFrame([("D", x) for x in "ABCE"], "db string, unid string")
    assert {(r["unid"], r["tries"]) for r in progress.remaining(cand, log).collect()} == {("A", 1), ("E", 0)}
    assert {r["unid"] for r in progress.retry_errors(log).collect()} == {"A"}
    path = str(tmp_path / "log")
    for i in range(3):
        log.where(F.col("line_no") % 3 == i).write.mode("append").parquet(path)
    live = {tuple(r) for r in progress_state.snapshot(spark, path, files_per_batch=1).select("db", "unid", "line_no", "status").collect()}
    assert live == {tuple(r) for r in progress.latest(log).select("db", "unid", "line_no", "status").collect()}


def test_files(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.xml").write_text(NOTE)
    (tmp_path / "x" / "bad.xml").write_text("<a>")
    parsed = {r["path"].rsplit("/", 1)[-1]: r for r in dxl.normalise(dxl.read_xml(spark, str(tmp_path / "x"))).collect()}
    assert parsed["a.xml"]["unid"] == "ABC" and parsed["a.xml"]["error"] is None and parsed["bad.xml"]["error"].startswith("ParseError")
    assert dxl.payloads(dxl.read_xml(spark, str(tmp_path / "x"))).count() == 2
    out = spark.createDataFrame([("a/b.txt", bytearray(b"x")), ("../no.txt", bytearray(b"y"))], "path string, content binary")
    done = {r["path"]: r["error"] for r in sinks.write_files(out, str(tmp_path / "out")).collect()}
    assert done["a/b.txt"] is None and done["../no.txt"] and (tmp_path / "out" / "a" / "b.txt").read_bytes() == b"x"
    assert files.inventory(spark, str(tmp_path / "out")).count() == 1
    log = spark.createDataFrame([("t", "D", "U", "done", 1)], "ts string, db string, unid string, status string, `try` int")
    sinks.append_log(log, str(tmp_path / "log"))
    sinks.append_log(log, str(tmp_path / "log"))
    assert files.progress_lines(spark, str(tmp_path / "log")).count() == 2


def test_attachment_names(spark):
    rows = [(1, "N", "a.001.txt", "file", None, None, "p/1"), (2, "N", "a.txt", "file", None, None, "p/2"), (3, "N", None, "image", None, None, None), (4, None, "a.txt", "file", "", "a.txt", None)]
    df = spark.createDataFrame(rows, "att_id long, unid string, name string, type string, saved_name string, ref_name string, content_path string")
    assert {(r["att_id"], r["file_name"]) for r in attachments.preferred_name(df).collect()} == {(1, "a.txt"), (2, "a_2.txt"), (3, "attachment.gif"), (4, "a.txt")}
    assert attachments.resolve(df).collect()[0]["path"] is None


def test_docx_and_pdf(spark):
    import io
    import re
    import zipfile
    import zlib
    from xml.etree import ElementTree

    doc, _ = dxl.parse(NOTE, "DB")
    records = spark.createDataFrame([(1, json.dumps(doc)), (2, "{"), (3, json.dumps({"meta": {"error": "bad"}, "fields": {}}))], "record_id long, payload string")
    out = {(r["record_id"], r["format"]): r for r in engine.render_files(records).collect()}
    assert out[2, "pdf"]["error"] == "no document" and out[2, "docx"]["content"] is None
    package = zipfile.ZipFile(io.BytesIO(bytes(out[1, "docx"]["content"])))
    tree = ElementTree.fromstring(package.read("word/document.xml"))
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    text = "".join(x.text or "" for x in tree.iter(f"{w}t"))
    assert "Hello | there" in text and "1. one2. two" in text.replace("\n", "") and "[D.txt]" in text and "Appendix" in text
    rows = [[len(tc.findall(f"{w}tcPr/{w}vMerge")) for tc in tr.findall(f"{w}tc")] for tr in next(tree.iter(f"{w}tbl")).findall(f"{w}tr")]
    assert rows == [[0], [1, 0], [1, 0]]
    pdf = bytes(out[1, "pdf"]["content"])
    assert pdf.startswith(b"%PDF-") and pdf.rstrip().endswith(b"%%EOF")
    streams = [zlib.decompress(x) for x in re.findall(rb"stream\n(.*?)\nendstream", pdf, re.S)]
    shown = "".join(bytes.fromhex(h.decode()).decode("utf-16-be") for s in streams for h in re.findall(rb"<([0-9a-f]+)>", s))
    assert "Hello | there" in shown and "1. one" in shown and "https://a.example" in shown
    start = int(pdf.rsplit(b"startxref", 1)[1].split()[0])
    assert pdf[start : start + 4] == b"xref"


def test_extraction_and_folders(spark, tmp_path):
    from folioforge.operators import extraction

    notes = spark.createDataFrame([("n1", NOTE), ("n2", "<broken")], "path string, xml string")
    got = {r["name"]: r for r in extraction.extract(notes).collect()}
    assert got["d.txt"]["file_name"] == "D.txt" and bytes(got["d.txt"]["content"]) == b"hello" and got["d.txt"]["content_path"] == "attachments/D.txt"
    assert got["inline_image_0"]["file_name"] == "inline_image_0.gif" and len(got) == 2
    refs = {r["t"]: r["content_path"] for r in extraction.references(notes, extraction.extract(notes)).collect()}
    assert refs == {"attachmentref": "attachments/D.txt", "img": "attachments/inline_image_0.gif"}
    folders = spark.createDataFrame([("a",), ("a/b",), ("a/c",), ("a/c/d",), ("e",)], "path string")
    held = spark.createDataFrame([("a/b/x.txt",)], "path string")
    assert {r["path"] for r in extraction.empty_folders(folders, held, keep=("e",)).collect()} == {"a/c", "a/c/d"}
    (tmp_path / "p.json").write_text(json.dumps({"profiles": [{"name": "a", "type": "x"}, {"type": "y"}, {"name": "a", "type": "z"}]}))
    assert {r["name"]: r["settings"]["type"] for r in files.profiles(spark, str(tmp_path / "p.json")).collect()} == {"a": "z", "profile_2": "y"}


def test_unique_names(spark):
    """Generated names count as well as given ones; notes don't meet; a name of another ending is another name."""
    from folioforge.operators.attachments import unique_names

    rows = [(1, "u", "a.txt"), (2, "u", "a.txt"), (3, "u", "a_2.txt"), (4, "u", "a.txt"), (5, "u", "a.pdf"), (6, "v", "a.txt"), (7, None, "a.txt"), (8, None, "a.txt"), (9, "u", "a_2.txt"), (10, "u", "x"), (11, "u", "x")]
    got = {r["i"]: r["file_name"] for r in unique_names(spark.createDataFrame(rows, "i int, unid string, pretty string"), "unid", "i").collect()}
    assert got == {1: "a.txt", 2: "a_2.txt", 3: "a_2_2.txt", 4: "a_3.txt", 5: "a.pdf", 6: "a.txt", 7: "a.txt", 8: "a_2.txt", 9: "a_2_3.txt", 10: "x", 11: "x_2"}
    taken = [got[i] for i, u, _ in rows if u == "u"]
    assert len(set(taken)) == len(taken)


def test_documents_to_files(spark, tmp_path):
    docs = spark.createDataFrame([("a/b.xml", '{"x": "ü"}'), ("../c.xml", "{}"), ("d", None)], "path string, payload string")
    for root in (str(tmp_path / "one"), f"file://{tmp_path}/two"):
        got = {r["path"]: r["error"] for r in sinks.write_documents(docs, root).collect()}
        assert got["a/b.json"] is None and got["../c.json"] and got["d.json"]
    assert (tmp_path / "one/a/b.json").read_text() == (tmp_path / "two/a/b.json").read_text() == '{"x": "ü"}'
    assert sorted(p.name for p in tmp_path.rglob("*") if p.is_file()) == ["b.json", "b.json"]


def test_written_notes_read_again():
    """Fonts, tables in sections in tables, links, pictures and paragraph styles survive the way through XML."""
    from folioforge.sources import dxl_writer

    cell = {"runs": [{"t": "text", "text": "a < b & 'c' \"d\"", "s": ["b", "s"], "a": {"color": "red", "script": "sub"}}], "colspan": 2}
    runs = [{"t": "par", "a": {"align": "justify", "list": {"type": "number"}}}, {"t": "text", "text": "x"}, {"t": "table", "columns": [{"width": "2in"}], "rows": [{"cells": [cell, {"runs": [{"t": "section", "title_runs": [{"t": "text", "text": "T"}], "body_runs": [{"t": "table", "rows": {"cells": {"runs": {"t": "hr"}}}}]}]}]}]}]
    runs += [{"t": "link", "href": "https://a.example/?x=1&y=2", "label": "L>"}, {"t": "link", "label": "N", "notes": {"unid": "U1", "replica": "R"}}, {"t": "img", "alt": "inline_image_0"}, {"t": "attachmentref", "name": "f'>.pdf", "displayname": "F"}]
    doc, payloads = dxl.parse(dxl_writer.write({"meta": {"unid": "U"}, "fields": {"Body": {"type": "richtext", "runs": runs}, "Cats": {"value": ["p", "q&"]}}}), "db")
    flat = [r["t"] for r in dxl.walk(doc["fields"]["Body"]["runs"])]
    assert [t for t in flat if t not in ("par", "text")] == ["table", "section", "table", "hr", "link", "link", "img", "attachmentref"]
    body = doc["fields"]["Body"]["runs"]
    assert body[0]["a"] == {"align": "justify", "list": {"type": "number", "raw": "number"}}
    first = next(r for r in body if r["t"] == "table")["rows"][0]["cells"][0]
    text = next(r for r in first["runs"] if r["t"] == "text")
    assert first["colspan"] == 2 and text["text"] == "a < b & 'c' \"d\"" and text["s"] == ["b", "s"] and text["a"]["script"] == "sub" and text["a"]["color"] == "red"
    assert doc["fields"]["Cats"]["value"] == ["p", "q&"] and doc["links"]["notes"][0]["unid"] == "U1" and len(payloads) == 1
    run = {"t": "text", "text": "deep"}
    for _ in range(3000):
        run = {"t": "section", "title_runs": [], "body_runs": [run]}
    assert dxl_writer.write({"fields": {"Body": {"runs": [run]}}}).count("<section>") == 3000
