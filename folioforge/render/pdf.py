"""Normalized documents to PDF: objects written by hand, text in a font that readers supply, so any script shows.

Kept: heading, paragraphs, lists, tables as rows of cells, sections, rules, appendix; long lines are wrapped, pages
broken. Styles, colours and pictures are not drawn; pictures and attachments are named.
"""

from __future__ import annotations

import unicodedata
import zlib

from folioforge.render.blocks import appendix, bodies, heading

WIDTH, HEIGHT, MARGIN = 595, 842, 56


def _plain(inline: list[dict]) -> str:
    out = []
    for r in inline:
        t = r.get("t")
        if t == "link":
            href = r.get("href") or (r.get("notes") or {}).get("unid") or ""
            label = r.get("label") or href
            out.append(label + (f" ({href})" if href and href != label else ""))
        else:
            out.append({"text": r.get("text") or "", "br": "\n", "img": f"[Image: {r.get('alt') or 'image'}]", "attachmentref": f"[{r.get('displayname') or r.get('name') or 'file'}]"}.get(t, f"[Unknown Run: {t}]"))
    return "".join(out)


def _lines(items: list[dict], depth: int = 0) -> list[tuple[str, int, int]]:
    """(text, size, indent) of each line before wrapping; a size of 0 is a rule."""
    out: list[tuple[str, int, int]] = []
    for b in items:
        kind = b["kind"]
        if kind == "p":
            indent = {"indent-1": 36, "indent-2": 72, "indent-3": 108}.get(b["indent"], 0)
            out += [(x, 10, indent + depth) for x in _plain(b["inline"]).split("\n")] + [("", 10, depth)] * (1 + b["breaks"])
        elif kind == "list":
            numbered = b["type"] not in ("bullet", "circle", "square", "check")
            out += [((f"{i}. " if numbered else "• ") + _plain(p["inline"]).replace("\n", " "), 10, 18 + depth) for i, p in enumerate(b["items"], 1)]
        elif kind == "hr":
            out.append(("", 0, depth))
        elif kind == "section":
            out.append((" ".join(_plain(p["inline"]) for p in b["title"] if p["kind"] == "p"), 12, depth))
            out += _lines(b["body"], depth + 12)
        else:
            for row in b["rows"]:
                cells = [" / ".join(x for x, size, _ in _lines(c["blocks"]) if size and x) for c in row["cells"]]
                out.append((" | ".join(cells), 10, 12 + depth))
            out.append(("", 10, depth))
    return out


def _width(c: str) -> float:
    return 1.0 if unicodedata.east_asian_width(c) in "WF" else 0.5


def _wrap(text: str, room: float) -> list[str]:
    """Lines that fit the room (in characters of full width), broken at blanks where there are any."""
    out, line, used, blank = [], "", 0.0, -1
    for c in text:
        if used + _width(c) > room and line:
            cut = blank if blank > 0 else len(line)
            out.append(line[:cut].rstrip())
            line = line[cut:].lstrip()
            used, blank = sum(map(_width, line)), line.rfind(" ")
        if c == " ":
            blank = len(line)
        line += c
        used += _width(c)
    return [*out, line]


def render(doc: dict) -> bytes:
    """The document; one with an error says so."""
    meta = doc.get("meta") or {}
    if meta.get("error"):
        rows = [("Render Error", 16, 0), (str(meta["error"]), 10, 0)]
    else:
        rows = [(heading(doc), 16, 0), ("", 10, 0), *_lines(list(bodies(doc)))]
        more = appendix(doc, 200, " …")
        if more:
            rows += [("Appendix", 13, 0), *[(f"{r['name']} ({r['type']}): {r['preview']}".replace("\n", " "), 10, 0) for r in more]]
    pages, ops, y = [], [], HEIGHT - MARGIN
    for text, size, indent in rows:
        for line in _wrap(text, (WIDTH - 2 * MARGIN - indent) / max(size, 1)) if size else [None]:
            height = (size or 6) * 1.4
            if y - height < MARGIN:
                pages.append(ops)
                ops, y = [], HEIGHT - MARGIN
            y -= height
            if line is None:
                ops.append(f"{MARGIN + indent} {y + 4:.1f} m {WIDTH - MARGIN} {y + 4:.1f} l S")
            elif line:
                ops.append(f"BT /F1 {size} Tf {MARGIN + indent} {y:.1f} Td <{line.encode('utf-16-be', 'replace').hex()}> Tj ET")
    pages.append(ops)
    objects = ["<< /Type /Catalog /Pages 2 0 R >>", "", "<< /Type /Font /Subtype /Type0 /BaseFont /HeiseiKakuGo-W5 /Encoding /UniJIS-UTF16-H /DescendantFonts [4 0 R] >>", "<< /Type /Font /Subtype /CIDFontType0 /BaseFont /HeiseiKakuGo-W5 /CIDSystemInfo << /Registry (Adobe) /Ordering (Japan1) /Supplement 5 >> /FontDescriptor 5 0 R /DW 1000 /W [1 [500] 2 230 500] >>", "<< /Type /FontDescriptor /FontName /HeiseiKakuGo-W5 /Flags 4 /FontBBox [0 -200 1000 900] /ItalicAngle 0 /Ascent 850 /Descent -150 /CapHeight 700 /StemV 80 >>"]
    kids, bodies_ = [], []
    for k, page in enumerate(pages):
        at = 6 + 2 * k
        kids.append(f"{at} 0 R")
        data = zlib.compress("\n".join(page).encode())
        bodies_ += [f"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 {WIDTH} {HEIGHT}] /Resources << /Font << /F1 3 0 R >> >> /Contents {at + 1} 0 R >>".encode(), f"<< /Length {len(data)} /Filter /FlateDecode >>\nstream\n".encode() + data + b"\nendstream"]
    objects[1] = f"<< /Type /Pages /Kids [{' '.join(kids)}] /Count {len(kids)} >>"
    out, places = bytearray(b"%PDF-1.5\n%\xe2\xe3\xcf\xd3\n"), []
    for k, body in enumerate([*(o.encode() for o in objects), *bodies_], 1):
        places.append(len(out))
        out += f"{k} 0 obj\n".encode() + body + b"\nendobj\n"
    start = len(out)
    out += f"xref\n0 {len(places) + 1}\n0000000000 65535 f \n".encode() + b"".join(f"{p:010d} 00000 n \n".encode() for p in places)
    return bytes(out + f"trailer << /Size {len(places) + 1} /Root 1 0 R >>\nstartxref\n{start}\n%%EOF\n".encode())
