"""Notes exported as XML to normalized documents.

One pass over the parser's events with a stack of open run lists (body, cell, section title, section body); no tree is
built, so a document needs memory for its output only. Payloads of files stay out of the document and are listed apart.

Differences from a literal reading of the format that users may meet are settled so: scalar items keep their type;
rich text that spans several items of one name is joined; blanks inside a paragraph are kept and only its ends are
trimmed (``trim_pieces`` trims every piece instead); inline pictures count in document order; unreadable sizes are 0;
control characters that XML forbids are taken out before parsing.

Defined results: a text that is no well-formed XML, or is empty, gives an error document with ``meta.error``; unknown
elements count as text; repeated item names: the last counts, rich text is joined.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Version of the format, and the items that a document shows itself.
SCHEMA_VERSION = "1.5-dev"
PRIMARY = ["Subject", "From", "To", "CC", "Body", "Categories", "Created", "Modified"]
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")
_STYLE_TAGS = {"b": "b", "i": "i", "u": "u", "strike": "s"}
# Elements whose text isn't part of rich text.
_SILENT = {"pardef", "parstyle", "fonttable", "colortable", "object", "file", "filedata", "gif", "jpeg", "png", "bmp", "notesbitmap", "caption", "region", "created", "modified", "datetime"}
_STAMP = re.compile(r"^(\d{4})(\d\d)(\d\d)T(\d\d)(\d\d)(\d\d)(?:,(\d+))?(?:([+-])(\d\d)(\d\d)?)?$")


def layout(rich_item: str) -> dict:
    return {"primary_fields_allowlist": PRIMARY, "used_in_body": ["Subject", rich_item]}


def stamp(raw: str | None) -> str | None:
    """A Domino stamp as ISO with its offset; bare dates as dates; anything else as it is."""
    raw = (raw or "").strip()
    if not raw:
        return None
    import datetime as dt

    try:
        if re.fullmatch(r"\d{8}", raw):
            return dt.date(int(raw[:4]), int(raw[4:6]), int(raw[6:])).isoformat()
        if m := _STAMP.match(raw):
            *parts, frac, sign, hh, mm = m.groups()
            shift = dt.timedelta(hours=int(hh or 0), minutes=int(mm or 0)) * (-1 if sign == "-" else 1)
            if abs(shift) >= dt.timedelta(hours=24):
                shift = dt.timedelta(0)
            return dt.datetime(*map(int, parts), int((frac or "0")[:6].ljust(6, "0")), dt.timezone(shift)).isoformat()
    except ValueError:
        pass
    return raw


def merge_style(first: dict, second: dict) -> dict:
    """Flags united and sorted, list attributes joined in order without repeats, other attributes from the later one."""
    flags = sorted({*first.get("s", ()), *second.get("s", ())})
    attrs = {k: list(v) if isinstance(v, list) else v for k, v in first.get("a", {}).items()}
    for k, v in second.get("a", {}).items():
        if isinstance(v, list):
            attrs[k] = list(dict.fromkeys([*attrs.get(k, ()), *v]))
        elif v is not None:
            attrs[k] = v
    return ({"s": flags} if flags else {}) | ({"a": attrs} if attrs else {})


def tag_style(tag: str, at: dict) -> dict:
    """Style that an element gives to the text in it."""
    flags, attrs = [], {}
    ground = at.get("bgcolor") or at.get("background") or at.get("highlight")
    if tag == "font":
        words = set(at.get("style", "").lower().replace(",", " ").split())
        flags = [f for f, names in (("b", {"bold"}), ("i", {"italic"}), ("u", {"underline"}), ("s", {"strikethrough", "strikeout"})) if words & names]
        attrs = {k: at[x] for k, x in (("color", "color"), ("size", "size"), ("font_family", "name")) if at.get(x)}
        fx = [k for k in ("shadow", "emboss", "extrude") if k in words]
        base = at.get("baseline") or at.get("position") or ""
        up, down = ("superscript" in words or base in ("super", "superscript")), ("subscript" in words or base in ("sub", "subscript"))
        if up != down:
            attrs["script"] = "super" if up else "sub"
            fx.append(attrs["script"])
        if fx:
            attrs["fx"] = fx
    elif tag in _STYLE_TAGS:
        flags = [_STYLE_TAGS[tag]]
    elif tag in ("sup", "sub"):
        script = "super" if tag == "sup" else "sub"
        attrs = {"script": script, "fx": [script]}
    if ground and tag in ("font", "run"):
        attrs["bgcolor"] = ground
    return ({"s": flags} if flags else {}) | ({"a": attrs} if attrs else {})


class _Runs:
    """A run list being filled."""

    def __init__(self, trim_pieces: bool):
        self.runs: list[dict] = []
        self.plain: list[str] = []
        self.trim, self.fresh = trim_pieces, True

    def par(self, attrs: dict) -> None:
        """A paragraph begins; one with the same attributes right after an empty one is dropped."""
        self.close_line()
        token = {"t": "par"} | ({"a": attrs} if attrs else {})
        if self.runs and self.runs[-1] == token:
            return
        if self.plain and not self.plain[-1].endswith("\n"):
            self.plain.append("\n")
        self.runs.append(token)
        self.fresh = True

    def open(self) -> None:
        if not self.runs:
            self.runs.append({"t": "par"})

    def close_line(self) -> None:
        """Trailing blanks of the paragraph go."""
        while self.runs and self.runs[-1]["t"] == "text" and self.plain:
            bare = self.runs[-1]["text"].rstrip()
            if bare == self.runs[-1]["text"]:
                break
            self.runs[-1]["text"] = self.plain[-1] = bare
            if bare:
                break
            self.runs.pop()
            self.plain.pop()

    def text(self, text: str, style: dict) -> None:
        text = text.strip() if self.trim else re.sub(r"[ \t\r\n]+", " ", text)
        if self.fresh or (self.runs and self.runs[-1]["t"] in ("br", "table", "section", "hr")):
            text = text.lstrip(" ")
        elif text.startswith(" ") and self.plain and self.plain[-1].endswith((" ", "\n")):
            text = text[1:]
        if not text:
            return
        self.open()
        last = self.runs[-1]
        if last["t"] == "text" and {k: last[k] for k in ("s", "a") if k in last} == style:
            last["text"] += text
            self.plain[-1] += text
        else:
            self.runs.append({"t": "text", "text": text} | style)
            self.plain.append(text)
        self.fresh = False

    def token(self, token: dict, plain: str) -> None:
        self.open()
        self.runs.append(token)
        if plain:
            self.plain.append(plain)
        self.fresh = False


class _Reader:
    def __init__(self, rich_item: str, trim_pieces: bool):
        self.rich_item, self.trim = rich_item, trim_pieces
        self.path: list[str] = []
        self.meta: dict = {}
        self.fields: dict[str, dict] = {}
        self.files: dict[str, dict] = {}
        self.pictures: list[dict] = []
        self.refs: dict[str, dict] = {}
        self.payloads: list[dict] = []
        self.pardefs: dict[str, dict] = {}
        self.item: dict | None = None
        self.stack: list[_Runs] = []
        self.tables: list[dict] = []
        self.sections: list[dict] = []
        self.styles: list[dict] = [{}]
        self.link: dict | None = None
        self.ref_name: str | None = None
        self.silent = 0
        self.tail_style: dict | None = None
        self.buffer: list[str] = []
        self.payload: dict | None = None
        self.pending: tuple[str, int] | None = None

    # events

    def start(self, tag: str, at: dict) -> None:
        tag = tag.rsplit(":", 1)[-1]
        self.path.append(tag)
        self.flush()
        self.tail_style = None
        self.pending = (tag, len(self.path))
        if tag == "pardef":
            attrs = {k: ("justify" if (k, v) == ("align", "full") else v) for k, v in at.items() if k in ("align", "leftmargin", "spaceafter") and v}
            if at.get("list"):
                attrs["list"] = {"type": at["list"], "raw": at["list"]}
            self.pardefs[at.get("id", "")] = attrs
            self.current_def = attrs
        elif tag == "parstyle" and "pardef" in self.path and at.get("name"):
            self.current_def["parstyle"] = at["name"]
        elif tag in ("note", "document") and len(self.path) == 1:
            self.meta |= {k: at[k] for k in ("form", "unid") if at.get(k)}
        elif tag == "noteinfo" and at.get("unid"):
            self.meta["unid"] = at["unid"]
        elif tag == "item" and self.item is None:
            self.item = {"name": at.get("name"), "kind": None, "values": [], "loose": []}
        elif tag == "file" and self.item and self.item["name"] == "$FILE":
            try:
                size = int(at.get("size", 0))
            except ValueError:
                size = 0
            if at.get("name"):
                self.files.setdefault(at["name"], {"name": at["name"], "type": "file", "ref": {"element": "file"}, "size": size, "created": None, "modified": None, "content_path": None, "saved_name": None})
                self.payload = {"element": "file", "name": at["name"], "index": None}
        elif tag == "picture":
            self.picture(at)
        elif self.item and self.item["kind"] is None and tag in ("textlist", "datetimelist", "numberlist", "text", "datetime", "number"):
            self.item["kind"] = tag
        elif tag == "richtext" and self.item and self.item["name"] == self.rich_item and not self.stack:
            self.item["kind"] = "richtext"
            self.stack.append(_Runs(self.trim))
        elif self.stack:
            self.rich_start(tag, at)
        if tag in _SILENT:
            self.silent += 1

    def end(self, tag: str) -> None:
        tag = tag.rsplit(":", 1)[-1]
        text = self.flush(tag)
        if tag in _SILENT:
            self.silent -= 1
        inside = self.path[:-1]
        if tag == "datetime" and "noteinfo" in inside and inside[-1] in ("created", "modified", "revised"):
            self.meta[inside[-1]] = stamp(text)
        elif tag == "datetime" and inside[-1:] in (["created"], ["modified"]) and "file" in inside and self.payload:
            self.files[self.payload["name"]][inside[-1]] = stamp(text)
        elif tag in ("filedata", "gif", "jpeg", "png", "bmp") and self.payload:
            self.keep(tag, text)
        elif tag == "item" and self.item is not None and "item" not in inside:
            self.close_item()
        elif tag == "richtext" and self.stack and "richtext" not in inside:
            own = self.stack.pop()
            own.close_line()
            self.item["values"] = own
        elif self.stack:
            self.rich_end(tag)
        elif self.item and self.item["kind"] in ("textlist", "datetimelist", "numberlist") and tag == self.item["kind"][:-4]:
            self.item["values"].append(text)
        elif self.item and tag == self.item["kind"]:
            self.item["values"].append(text)
        if self.pending == (tag, len(self.path)) and tag == "font" and self.stack:
            self.tail_style = merge_style(self.styles[-1], self.emptied)
        self.path.pop()

    def data(self, text: str) -> None:
        self.buffer.append(text)

    def flush(self, closing: str | None = None) -> str:
        text, self.buffer = "".join(self.buffer), []
        if closing is None or self.stack:
            if self.stack and not self.silent and text:
                if self.link is not None:
                    self.link["label"].append(text)
                elif self.ref_name is None:
                    self.stack[-1].text(text, self.tail_style if self.tail_style is not None and text.strip() else self.styles[-1])
                    if text.strip():
                        self.tail_style = None
            elif self.item and text.strip() and not self.silent:
                self.item["loose"].append(text.strip())
        elif self.item and text.strip() and closing not in (self.item["kind"], (self.item["kind"] or "")[:-4]) and not self.silent:
            self.item["loose"].append(text.strip())
        return text.strip()

    # rich text

    def rich_start(self, tag: str, at: dict) -> None:
        own = self.stack[-1]
        if tag == "par":
            own.par({k: v for k, v in self.pardefs.get(at.get("def", ""), {}).items() if v})
        elif tag in ("font", "b", "i", "u", "strike", "sup", "sub", "run"):
            style = tag_style(tag, at)
            self.emptied = style
            if self.link is not None:
                self.link["style"] = merge_style(self.link["style"], style)
            self.styles.append(merge_style(self.styles[-1], style))
        elif tag in ("br", "break"):
            own.token({"t": "br"}, "\n")
        elif tag == "horizrule":
            own.token({"t": "hr"} | ({"a": at} if at else {}), "\n---\n")
        elif tag in ("urllink", "doclink") and self.link is None:
            self.link = {"tag": tag, "at": at, "label": [], "style": {}}
        elif tag == "attachmentref" and at.get("name"):
            shown = (at.get("displayname") or at["name"]).strip()
            self.refs.setdefault(at["name"], {"name": shown, "ref": {"element": "attachmentref", "name": at["name"]}})
            own.token({"t": "attachmentref", "name": at["name"], "displayname": shown} | self.styles[-1], f"[{shown}]")
            self.ref_name = at["name"]
        elif tag == "table":
            self.tables.append({"t": "table", "rows": []} | ({"attributes": at} if at else {}))
        elif tag == "tablecolumn" and self.tables:
            self.tables[-1].setdefault("columns", []).append({"width": at["width"]} if at.get("width") else {})
        elif tag == "tablerow" and self.tables:
            self.tables[-1]["rows"].append(({"attributes": at} if at else {}) | {"cells": []})
        elif tag == "tablecell" and self.tables and self.tables[-1]["rows"]:
            cell = {k: int(at[k]) for k in ("colspan", "rowspan") if at.get(k, "").isdigit()}
            style = {k: v for k, v in at.items() if k not in ("colspan", "rowspan")}
            self.tables[-1]["rows"][-1]["cells"].append(cell | ({"style": style} if style else {}))
            self.stack.append(_Runs(self.trim))
            self.styles.append({})
        elif tag == "section":
            self.sections.append({"t": "section", "title_runs": []} | ({"attributes": at} if at else {}))
            self.stack.append(_Runs(self.trim))
        elif tag == "sectiontitle" and self.sections:
            self.stack.append(_Runs(self.trim))

    def rich_end(self, tag: str) -> None:
        if tag in ("font", "b", "i", "u", "strike", "sup", "sub", "run"):
            self.styles.pop()
        elif tag == "attachmentref":
            self.ref_name = None
        elif tag in ("urllink", "doclink") and self.link and self.link["tag"] == tag:
            link, self.link = self.link, None
            self.close_link(tag, link["at"], "".join(link["label"]).strip(), link["style"])
        elif tag == "par":
            self.stack[-1].close_line()
            self.stack[-1].fresh = True
        elif tag == "tablecell" and len(self.stack) > 1:
            own = self.stack.pop()
            own.close_line()
            self.styles.pop()
            self.tables[-1]["rows"][-1]["cells"][-1]["runs"] = own.runs
            if plain := "".join(own.plain).rstrip():
                self.stack[-1].plain.append(plain + " ")
        elif tag == "table" and self.tables:
            self.stack[-1].token(self.tables.pop(), "")
        elif tag == "sectiontitle" and len(self.stack) > 1:
            own = self.stack.pop()
            own.close_line()
            self.sections[-1]["title_runs"] = own.runs
        elif tag == "section" and len(self.stack) > 1:
            own = self.stack.pop()
            own.close_line()
            self.stack[-1].token(self.sections.pop() | {"body_runs": own.runs}, "")

    def close_link(self, tag: str, at: dict, label: str, style: dict) -> None:
        style = merge_style(merge_style(self.styles[-1], style), {"s": ["u"]})
        if tag == "urllink":
            href = at.get("href", "").strip()
            token = {"t": "link", "href": href, "label": label or at.get("title") or href or "Notes Link"}
        else:
            notes = {"server": at.get("server"), "replica": at.get("database") or at.get("db"), "unid": at.get("document") or at.get("unid"), "view": at.get("view")}
            token = {"t": "link", "href": "", "label": label or at.get("description") or "DocLink", "notes": {k: v for k, v in notes.items() if v}}
        self.stack[-1].token(token | style, token["label"])

    def picture(self, at: dict) -> None:
        """A picture of a reference is its icon; any other is an inline image, numbered in document order."""
        if self.ref_name is not None:
            self.payload = None
            return
        sides = [re.sub(r"px$", "", at.get(k, "0")) for k in ("width", "height")]
        size = int(sides[0]) * int(sides[1]) if all(s.isdigit() for s in sides) else 0
        index = len(self.pictures)
        self.pictures.append({"name": f"inline_image_{index}", "type": "image", "ref": {"element": "picture", "index": index}, "size": size, "created": None, "modified": None, "content_path": None, "saved_name": None})
        self.payload = {"element": "picture", "name": f"inline_image_{index}", "index": index}
        if self.stack:
            self.stack[-1].token({"t": "img", "alt": f"inline_image_{index}"}, f"[Image: inline_image_{index}]")

    def keep(self, tag: str, text: str) -> None:
        try:
            data = base64.b64decode("".join(text.split()), validate=False)
        except (binascii.Error, ValueError):
            data = b""
        self.payloads.append(self.payload | {"format": tag, "content": data})
        if self.payload["element"] == "picture" and tag == "gif":
            self.pictures[self.payload["index"]]["size"] = len(data)
        self.payload = None

    def close_item(self) -> None:
        item, self.item = self.item, None
        name, kind, values = item["name"], item["kind"], item["values"]
        if not name or name.startswith("$") or name == "Form":
            if name == "Form" and values and isinstance(values, list):
                self.meta.setdefault("form", values[0])
            return
        if kind == "richtext":
            text = "".join(values.plain).rstrip()
            if name in self.fields and self.fields[name]["type"] == "richtext":
                self.fields[name]["runs"] += values.runs
                self.fields[name]["text"] += "\n" + text
            else:
                self.fields[name] = {"type": "richtext", "text": text, "runs": values.runs}
            return
        values = [v for v in values if v]
        if kind in ("datetime", "datetimelist"):
            values = [x for x in map(stamp, values) if x]
        if kind and kind.endswith("list"):
            if values:
                self.fields[name] = {"type": kind, "value": values}
        elif values:
            self.fields[name] = {"type": kind, "value": values[0]}
        elif item["loose"]:
            self.fields[name] = {"type": "text", "value": "".join(item["loose"]), "notes": "Fallback text"}

    def document(self, db_title: str) -> dict:
        found = list(self.files.values()) + self.pictures
        named = {a["name"] for a in found}
        for key, ref in self.refs.items():
            if key not in named and ref["name"] not in named:
                found.append({"name": ref["name"], "type": "file", "ref": ref["ref"], "size": 0, "created": None, "modified": None, "content_path": None, "saved_name": None})
        order = lambda a: (a["type"] == "image", a["ref"].get("index", 0) if a["type"] == "image" else 0, a["name"])
        links = {"notes": [], "http": []}
        for field in self.fields.values():
            for run in walk(field.get("runs", ())):
                if run["t"] == "link" and run.get("notes", {}).get("unid"):
                    n = run["notes"]
                    links["notes"].append({k: v for k, v in {"raw": "notes:///" + "/".join([n.get("server", ""), n.get("replica", ""), n.get("view", "0"), n["unid"]]), "server": n.get("server"), "replica": n.get("replica"), "unid": n["unid"], "meta": {"label": run["label"]}}.items() if v is not None})
                elif run["t"] == "link" and run["href"].lower().startswith(("http://", "https://")):
                    links["http"].append({"raw": run["href"], "label": run["label"], "resolved": None})
        return {"schema_version": SCHEMA_VERSION, "meta": {"db_title": db_title, "schema_version": SCHEMA_VERSION} | self.meta, "fields": self.fields, "attachments": sorted(found, key=order), "links": links, "layout": layout(self.rich_item)}


def walk(runs) -> Iterator[dict]:
    """All runs at any depth in document order."""
    todo = list(reversed(list(runs)))
    while todo:
        run = todo.pop()
        yield run
        below = [c for r in run.get("rows", ()) for cell in r.get("cells", ()) for c in cell.get("runs", ())] + list(run.get("title_runs", ())) + list(run.get("body_runs", ()))
        todo += reversed(below)


def parse(xml: str | None, db_title: str, rich_item: str = "Body", trim_pieces: bool = False) -> tuple[dict, list[dict]]:
    """(normalized document, payloads of files and pictures). Never raises on bad input."""
    reader = _Reader(rich_item, trim_pieces)
    text = _CONTROL.sub("", (xml or "").lstrip("﻿"))
    text = re.sub(r"^<\?xml[^>]*\?>", "", text)
    machine = expat.ParserCreate()
    machine.buffer_text = True
    machine.StartElementHandler, machine.EndElementHandler, machine.CharacterDataHandler = reader.start, reader.end, reader.data
    try:
        machine.Parse(text.encode("utf-8", "replace"), True)
    except expat.ExpatError as e:
        return {"schema_version": SCHEMA_VERSION, "meta": {"db_title": db_title, "schema_version": SCHEMA_VERSION, "error": f"ParseError: {e}"}, "fields": {}, "attachments": [], "links": {"notes": [], "http": []}, "layout": layout(rich_item)}, []
    return reader.document(db_title), reader.payloads


def read_xml(spark: SparkSession, folder: str, pattern: str = "*.xml") -> DataFrame:
    """path and text of the XML files below a folder, undecodable bytes replaced."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.decode("content", "UTF-8").alias("xml"))


def normalise(notes: DataFrame, rich_item: str = "Body", trim_pieces: bool = False) -> DataFrame:
    """Rows (path, xml[, db_title]) to path, unid, db_title, error, payload (the normalized document as JSON)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, xml, db in zip(pdf["path"], pdf["xml"], pdf["db_title"], strict=True):
                doc, _ = parse(xml, db, rich_item, trim_pieces)
                out.append((path, doc["meta"].get("unid"), db, doc["meta"].get("error") or (None if doc["meta"].get("unid") else "Missing UNID"), json.dumps(doc, ensure_ascii=False)))
            yield pd.DataFrame(out, columns=["path", "unid", "db_title", "error", "payload"])

    title = F.col("db_title") if "db_title" in notes.columns else F.lit("")
    return notes.select("path", "xml", title.alias("db_title")).mapInPandas(run, "path string, unid string, db_title string, error string, payload string")


def payloads(notes: DataFrame) -> DataFrame:
    """path, element, name, index, format, content of the files and pictures in each note; empty ones are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, xml in zip(pdf["path"], pdf["xml"], strict=True):
                own = [p for p in parse(xml, "")[1] if p["content"]]
                if own:
                    yield pd.DataFrame({"path": path, "element": [p["element"] for p in own], "name": [p["name"] for p in own], "index": pd.array([p["index"] for p in own], dtype="Int32"), "format": [p["format"] for p in own], "content": [p["content"] for p in own]})

    return notes.select("path", "xml").mapInPandas(run, "path string, element string, name string, index int, format string, content binary")
