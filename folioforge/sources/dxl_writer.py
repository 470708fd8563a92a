"""Normalized documents to note XML, the inverse of ``sources.dxl``: what an export of the note would hold.

Paragraph marks become paragraphs with definitions, styles become font elements, tables, sections, links, pictures and
references their elements, at any depth: containers wait on a stack of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators import nested

_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")
# Words of a font's style, by flag.
_WORDS = {"b": "bold", "i": "italic", "u": "underline", "s": "strikethrough"}
_PIXEL = "R0lGODlhAQABAIAAAAAAAP///yH5BAEAAAAALAAAAAABAAEAAAIBRAA7"


def _text(value) -> str:
    return escape(_CONTROL.sub("", value if isinstance(value, str) else "" if value is None else str(value)))


def _tag(element: str, /, **attributes) -> str:
    own = "".join(f" {k}={quoteattr(_CONTROL.sub('', str(v)))}" for k, v in attributes.items() if v not in (None, "", [], {}))
    return f"<{element}{own}>"


def _empty(element: str, /, **attributes) -> str:
    return _tag(element, **attributes)[:-1] + "/>"


def _objects(value) -> list[dict]:
    """The objects in a list as delivered, lists in it included."""
    out, todo = [], list(reversed(nested._entries(value)))
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            out.append(x)
        elif isinstance(x, list):
            todo += reversed(x)
    return out


def _styled(run: dict) -> tuple[str, str]:
    """What opens and closes around a piece of text."""
    own = run.get("a") if isinstance(run.get("a"), dict) else {}
    flags = run.get("s") if isinstance(run.get("s"), list) else []
    words = [_WORDS[f] for f in flags if f in _WORDS] + [f"{own['script']}script" for _ in "x" if own.get("script") in ("super", "sub")]
    return _tag("run", highlight=own.get("bgcolor")) + _empty("font", style=" ".join(words), color=own.get("color"), size=own.get("size"), name=own.get("font_family")), "</run>"


class _Writer:
    def __init__(self):
        self.out: list[str] = []
        self.defs: dict[str, str] = {}
        self.todo: list = []
        self.open: list[bool] = []  # per list of runs, whether a paragraph is open

    def runs(self, value) -> None:
        self.todo += ["end runs", *reversed(_objects(value)), "begin runs"]

    def par(self, attributes: dict | None = None) -> None:
        if self.open[-1]:
            self.out.append("</par>")
        own = attributes if isinstance(attributes, dict) else {}
        listed = own.get("list")
        key = _tag("pardef", align="full" if own.get("align") == "justify" else own.get("align"), leftmargin=own.get("leftmargin"), spaceafter=own.get("spaceafter"), list=listed.get("type") if isinstance(listed, dict) else None)
        number = self.defs.setdefault(key, str(len(self.defs) + 1))
        self.out.append(f"<par def='{number}'>")
        self.open[-1] = True

    def step(self, x) -> None:
        if x == "begin runs":
            self.open.append(False)
        elif x == "end runs":
            if self.open.pop():
                self.out.append("</par>")
        elif isinstance(x, str):
            self.out.append(x)
        elif isinstance(x, tuple):
            self.runs(x[0])
        elif x.get("t") == "par":
            self.par(x.get("a"))
        else:
            if not self.open[-1]:
                self.par()
            self.token(x)

    def token(self, run: dict) -> None:
        kind = run.get("t")
        if kind == "text":
            begin, end = _styled(run)
            self.out += [begin, _text(run.get("text")), end]
        elif kind == "br":
            self.out.append("<break/>")
        elif kind == "hr":
            self.out.append("<horizrule/>")
        elif kind == "link":
            notes = run.get("notes") if isinstance(run.get("notes"), dict) else None
            begin = _tag("doclink", server=notes.get("server"), database=notes.get("replica"), document=notes.get("unid"), view=notes.get("view")) if notes else _tag("urllink", href=run.get("href"))
            self.out += [begin, _text(run.get("label")), "</doclink>" if notes else "</urllink>"]
        elif kind == "img":
            self.out.append(f"<picture width='1px' height='1px'><gif>{_PIXEL}</gif></picture>")
        elif kind == "attachmentref":
            self.out.append(_empty("attachmentref", name=run.get("name") or run.get("displayname") or "?", displayname=run.get("displayname")))
        elif kind == "table":
            self.out.append("<table>" + "".join(_empty("tablecolumn", width=c.get("width")) for c in _objects(run.get("columns"))))
            steps: list = []
            for row in _objects(run.get("rows")):
                steps.append("<tablerow>")
                for cell in _objects(row.get("cells")):
                    steps += [_tag("tablecell", colspan=cell.get("colspan"), rowspan=cell.get("rowspan")), (cell.get("runs"),), "</tablecell>"]
                steps.append("</tablerow>")
            self.todo += reversed([*steps, "</table>"])
        elif kind == "section":
            self.todo += reversed(["<section><sectiontitle>", (run.get("title_runs"),), "</sectiontitle>", (run.get("body_runs"),), "</section>"])

    def rich(self, runs) -> str:
        self.runs(runs)
        while self.todo:
            self.step(self.todo.pop())
        defs = "".join(k.replace("<pardef", f"<pardef id='{n}'", 1)[:-1] + "/>" for k, n in self.defs.items())
        return "<richtext>" + defs + "".join(self.out) + "</richtext>"


def write(doc: dict, rich_item: str = "Body") -> str:
    """XML of a normalized document: its meta data, its items, its rich text."""
    meta = doc.get("meta") if isinstance(doc.get("meta"), dict) else {}
    fields = nested._opened(doc.get("fields"))
    items = []
    for name, field in (fields.items() if isinstance(fields, dict) else ()):
        field = nested._opened(field) if isinstance(field, str) else field
        value = field.get("value") if isinstance(field, dict) else None
        if name == rich_item and isinstance(field, dict):
            items.append(_tag("item", name=name) + _Writer().rich(field.get("runs")) + "</item>")
        elif isinstance(value, list):
            items.append(_tag("item", name=name) + "<textlist>" + "".join(f"<text>{_text(v)}</text>" for v in value) + "</textlist></item>")
        elif value is not None:
            items.append(_tag("item", name=name) + f"<text>{_text(value)}</text></item>")
    return _tag("note", form=meta.get("form")) + _empty("noteinfo", unid=meta.get("unid")) + "".join(items) + "</note>"


def export(records: DataFrame) -> DataFrame:
    """(record_id, db_title, payload) to (path, db_title, xml). A payload that is no document goes out as it is."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            docs = [nested.load(p) for p in pdf["payload"]]
            yield pd.DataFrame({"path": pdf["record_id"].astype(str), "db_title": pdf["db_title"], "xml": [p if d is None else write(d) for p, d in zip(pdf["payload"], docs, strict=True)]})

    return records.select(F.col("record_id").cast("long").alias("record_id"), "db_title", F.col("payload").cast("string").alias("payload")).mapInPandas(run, "path string, db_title string, xml string")
