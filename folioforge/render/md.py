"""Normalized documents to Markdown."""

from __future__ import annotations

import re

from folioforge.render.blocks import appendix, bodies, heading


def _code(text: str) -> str:
    fence = "`" * (max(map(len, re.findall("`+", text)), default=0) + 1)
    pad = " " if text[:1] == "`" or text[-1:] == "`" else ""
    return f"{fence}{pad}{text}{pad}{fence}"


def _address(href: str) -> str:
    return href.replace("(", "\\(").replace(")", "\\)").replace(" ", "%20")


def _label(text: str) -> str:
    return text.replace("[", "\\[").replace("]", "\\]")


def _inline(run: dict) -> str:
    t, a, s = run.get("t"), run.get("a") or {}, run.get("s") or []
    if t == "link":
        href = run.get("href") or ("Notes://" + run["notes"]["unid"] if (run.get("notes") or {}).get("unid") else "#")
        return f"[{_label(run.get('label') or href)}]({_address(href)})"
    if t == "img":
        src = run.get("src") or run.get("content_path")
        alt = _label(run.get("alt") or "image")
        return f"![{alt}]({_address(src)})" if src else f"*[Image: {alt}]*"
    if t == "attachmentref":
        shown, to = _label(run.get("displayname") or run.get("name") or "file"), run.get("content_path")
        return f"[{shown}]({_address(to)})" if to else f"*[Attachment: {shown}]*"
    if t == "br":
        return "  \n"
    if t != "text":
        return f"`[Unknown Run: {t}]`"
    out = run.get("text") or ""
    if not out:
        return ""
    script = a.get("script") or next((f for f in a.get("fx") or () if f in ("super", "sub")), None)
    if script:
        tag = "sup" if script == "super" else "sub"
        out = f"<{tag}>{out}</{tag}>"
    if "mono" in s:
        out = _code(out)
    for flags, mark in ((("s", "strike"), "~~"), (("i",), "*"), (("b",), "**")):
        if any(f in s for f in flags):
            out = f"{mark}{out}{mark}"
    return out


def _cell(items: list[dict]) -> str:
    parts = []
    for b in items:
        if b["kind"] == "table":
            parts.append("[Nested Table]")
        else:
            for p in b.get("items", [b]):
                parts.append("".join(_inline(r).replace("  \n", "<br>") for r in p.get("inline", ())))
    return "<br>".join(parts).replace("|", "\\|").replace("\n", "<br>")


def _blocks(items: list[dict], level: int = 3) -> list[str]:
    out = []
    for b in items:
        kind = b["kind"]
        if kind == "p":
            out.append("".join(map(_inline, b["inline"])))
        elif kind == "list":
            ordered = b["type"] not in ("bullet", "circle", "square", "check")
            out.append("\n".join(f"{f'{i}.' if ordered else '-'} " + "".join(map(_inline, p["inline"])) for i, p in enumerate(b["items"], 1)))
        elif kind == "hr":
            out.append("---")
        elif kind == "section":
            out.append("#" * min(6, level) + " " + "".join(_inline(r) for p in b["title"] if p["kind"] == "p" for r in p["inline"]))
            out += _blocks(b["body"], level + 1)
        elif b["rows"]:
            rows = [[_cell(c["blocks"]) for c in r["cells"]] for r in b["rows"]]
            width = max(1, len(rows[0]))
            rows = [(r + [""] * width)[:width] for r in rows]
            out.append("\n".join(["| " + " | ".join(rows[0]) + " |", "|" + " --- |" * width, *("| " + " | ".join(r) + " |" for r in rows[1:])]))
    return out


def render(doc: dict) -> str:
    """The document in Markdown: heading, body, appendix; an error text where the document is one."""
    meta = doc.get("meta") or {}
    if meta.get("error"):
        return f"**Render Error:**\n\n```\n{meta['error']}\n```\n"
    parts = [f"# {heading(doc)}", *_blocks(list(bodies(doc)))]
    rows = appendix(doc, 100, " ...")
    if rows:
        parts.append("## Appendix\n\n| Name | Type | Value |\n| --- | --- | --- |\n" + "\n".join(f"| {r['name']} | {r['type']} | " + r["preview"].replace("|", "\\|").replace("\n", "<br>") + " |" for r in rows))
    return "\n\n".join(p for p in parts if p) + "\n"
