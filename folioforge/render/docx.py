"""Normalized documents to DOCX: the parts of the package are written by hand, no library is needed.

Kept: heading, paragraphs with alignment and indent, runs with their styles and colours, lists with numbers, tables with
column and row spans, sections as headings, links as their label and address, rules, appendix. Pictures are named.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.sax.saxutils import escape

from folioforge.render.blocks import appendix, bodies, heading

_W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
# The smallest package that word processors open.
_PARTS = {
    "[Content_Types].xml": '<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>',
    "_rels/.rels": '<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>',
}
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def _text(text: str) -> str:
    return f'<w:t xml:space="preserve">{escape(_CONTROL.sub("", text))}</w:t>'


def _run(text: str, s=(), a: dict | None = None, bold: bool = False, size: int = 0) -> str:
    a = a or {}
    props = ("<w:b/>" if bold or "b" in s else "") + ("<w:i/>" if "i" in s else "") + ("<w:strike/>" if "s" in s or "strike" in s else "")
    if re.fullmatch(r"#[0-9A-Fa-f]{6}", str(a.get("color") or "")):
        props += f'<w:color w:val="{a["color"][1:].upper()}"/>'
    points = re.fullmatch(r"(\d+(?:\.\d+)?)pt", str(a.get("size") or ""))
    if points or size:
        props += f'<w:sz w:val="{size or round(float(points.group(1)) * 2)}"/>'
    props += '<w:u w:val="single"/>' if "u" in s else ""
    if re.fullmatch(r"#[0-9A-Fa-f]{6}", str(a.get("bgcolor") or "")):
        props += f'<w:shd w:val="clear" w:color="auto" w:fill="{a["bgcolor"][1:].upper()}"/>'
    script = a.get("script") or next((f for f in a.get("fx") or () if f in ("super", "sub")), None)
    props += f'<w:vertAlign w:val="{"superscript" if script == "super" else "subscript"}"/>' if script else ""
    return f"<w:r>{f'<w:rPr>{props}</w:rPr>' if props else ''}{_text(text)}</w:r>"


def _inline(run: dict) -> str:
    t, s, a = run.get("t"), run.get("s") or (), run.get("a") or {}
    if t == "br":
        return "<w:r><w:br/></w:r>"
    if t == "link":
        href = run.get("href") or (run.get("notes") or {}).get("unid") or ""
        label = run.get("label") or href
        return _run(label + (f" ({href})" if href and href != label else ""), {*s, "u"}, a)
    if t == "img":
        return _run(f"[Image: {run.get('alt') or 'image'}]", ("i",))
    if t == "attachmentref":
        return _run(f"[{run.get('displayname') or run.get('name') or 'file'}]", ("i",))
    return _run(run.get("text") or "", s, a) if t == "text" else _run(f"[Unknown Run: {t}]")


def _par(inline: str, a: dict | None = None, indent: int = 0) -> str:
    align = {"center": "center", "right": "right", "full": "both", "justify": "both"}.get((a or {}).get("align"))
    props = (f'<w:ind w:left="{indent}"/>' if indent else "") + (f'<w:jc w:val="{align}"/>' if align else "")
    return f"<w:p>{f'<w:pPr>{props}</w:pPr>' if props else ''}{inline}</w:p>"


def _number(value, default: int = 1) -> int:
    return int(value) if str(value).isdigit() and int(value) > 0 else default


def _table(block: dict) -> str:
    rows: list[str] = []
    below: dict[int, tuple[int, int]] = {}  # column -> (span, rows still covered by a cell above)
    for row in block["rows"]:
        out, col, todo, fresh = [], 0, list(row["cells"]), {}
        while todo or any(c >= col for c in below):
            if col in below:
                span, left = below.pop(col)
                out.append(f'<w:tc><w:tcPr><w:gridSpan w:val="{span}"/><w:vMerge/></w:tcPr><w:p/></w:tc>')
                if left > 1:
                    fresh[col] = (span, left - 1)
            elif todo:
                cell = todo.pop(0)
                span, down = _number(cell.get("colspan")), _number(cell.get("rowspan"))
                merge = '<w:vMerge w:val="restart"/>' if down > 1 else ""
                out.append(f'<w:tc><w:tcPr><w:gridSpan w:val="{span}"/>{merge}</w:tcPr>{_cell(cell["blocks"])}</w:tc>')
                if down > 1:
                    fresh[col] = (span, down - 1)
            else:
                out.append("<w:tc><w:p/></w:tc>")
                span = 1
            col += span
        below = fresh
        rows.append("<w:tr>" + ("".join(out) or "<w:tc><w:p/></w:tc>") + "</w:tr>")
    sides = "".join(f'<w:{side} w:val="single" w:sz="4"/>' for side in ("top", "left", "bottom", "right", "insideH", "insideV"))
    return f"<w:tbl><w:tblPr><w:tblBorders>{sides}</w:tblBorders></w:tblPr>{''.join(rows)}</w:tbl>"


def _cell(items: list[dict]) -> str:
    """A cell's blocks; the last must be a paragraph."""
    out = _blocks(items)
    return out if out.endswith("</w:p>") or out.endswith("<w:p/>") else out + "<w:p/>"


def _blocks(items: list[dict], level: int = 26) -> str:
    out = []
    for b in items:
        kind = b["kind"]
        if kind == "p":
            indent = {"indent-1": 720, "indent-2": 1440, "indent-3": 2160}.get(b["indent"], 0)
            out.append(_par("".join(map(_inline, b["inline"])) + "<w:r><w:br/></w:r>" * b["breaks"], b["a"], indent))
        elif kind == "list":
            numbered = b["type"] not in ("bullet", "circle", "square", "check")
            out += [_par(_run(f"{i}. " if numbered else "• ") + "".join(map(_inline, p["inline"])), p["a"], 360) for i, p in enumerate(b["items"], 1)]
        elif kind == "hr":
            out.append('<w:p><w:pPr><w:pBdr><w:bottom w:val="single" w:sz="6" w:space="1" w:color="auto"/></w:pBdr></w:pPr></w:p>')
        elif kind == "section":
            title = "".join(r.get("text") or r.get("label") or "" for p in b["title"] if p["kind"] == "p" for r in p["inline"])
            out.append(_par(_run(title, bold=True, size=level)))
            out.append(_blocks(b["body"], max(20, level - 2)))
        else:
            out.append(_table(b))
    return "".join(out)


def render(doc: dict) -> bytes:
    """The package of a document; one with an error says so."""
    meta = doc.get("meta") or {}
    if meta.get("error"):
        body = _par(_run("Render Error", bold=True, size=32)) + _par(_run(str(meta["error"])))
    else:
        body = _par(_run(heading(doc), bold=True, size=32)) + _blocks(list(bodies(doc)))
        rows = appendix(doc, 200, " …")
        if rows:
            cells = lambda r: [{"blocks": [{"kind": "p", "a": {}, "inline": [{"t": "text", "text": str(r[k])}], "indent": "", "breaks": 0}]} for k in ("name", "type", "preview")]
            body += _par(_run("Appendix", bold=True, size=28)) + _table({"rows": [{"cells": cells(r)} for r in rows]}) + "<w:p/>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in {**_PARTS, "word/document.xml": f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><w:document {_W}><w:body>{body}</w:body></w:document>'}.items():
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), text)  # the same bytes each time
    return out.getvalue()
