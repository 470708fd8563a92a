"""Normalized documents to HTML: own emitter, no template engine."""

from __future__ import annotations

import re
from html import escape

from folioforge.render.blocks import appendix, bodies, heading

# Style sheet of a page.
CSS = "body{font-family:sans-serif;max-width:60em;margin:1em auto}table{border-collapse:collapse}td,th{border:1px solid #999;padding:.2em .4em}.indent-1{margin-left:2em}.indent-2{margin-left:4em}.indent-3{margin-left:6em}.skip{position:absolute;left:-999em}"
_TAGS = (("b", "strong"), ("i", "em"), ("u", "u"), ("s", "s"))
_OL = {"number": "1", "alphaupper": "A", "alphalower": "a", "romanupper": "I", "romanlower": "i"}
_SHADOW = {"shadow": "1px 1px 2px rgba(0,0,0,.5)", "emboss": "-1px -1px 1px rgba(255,255,255,.8)", "extrude": "1px 1px 0 rgba(0,0,0,.4)"}


def _css(a: dict, styles=()) -> str:
    parts = [f"{css}: {a[k]};" for k, css in (("color", "color"), ("bgcolor", "background-color"), ("size", "font-size"), ("font_family", "font-family")) if a.get(k)]
    parts += [f"text-shadow: {_SHADOW[f]};" for f in a.get("fx") or () if f in _SHADOW]
    if "mono" in styles:
        parts.append("font-family: monospace;")
    return " ".join(parts)


def _inline(run: dict, options: dict) -> str:
    t, a, s = run.get("t"), run.get("a") or {}, run.get("s") or []
    if t == "text":
        out = escape(run.get("text") or "")
    elif t == "link":
        href, notes = run.get("href") or "", run.get("notes") or {}
        if notes.get("unid") and not href:
            host = re.sub(r"(?i)^CN=", "", notes.get("server") or "").split("/")[0]
            href = "Notes://" + "/".join(x for x in (host, notes.get("replica"), notes.get("view"), notes["unid"]) if x)
        safe = href if re.match(r"(?i)(https?|mailto|notes):", href) else ""
        out = f'<a href="{escape(safe)}" target="_blank" rel="noopener">{escape(run.get("label") or href)}</a>' if safe else escape(run.get("label") or href)
    elif t == "attachmentref":
        to, shown = run.get("content_path"), run.get("displayname") or run.get("name") or "file"
        out = f'<a class="attachment" href="{escape(to)}">{escape(shown)}</a>' if to else f'<span class="attachment">{escape(shown)}</span>'
    elif t == "img":
        src = run.get("src") or run.get("content_path")
        out = f'<img src="{escape(src)}" alt="{escape(run.get("alt") or "")}">' if src else f'<span class="missing">[Image: {escape(run.get("alt") or "image")}]</span>'
    elif t == "br":
        return "<br>"
    else:
        return f"<code>[Unknown Run: {escape(str(t))}]</code>"
    script = a.get("script") or next((f for f in a.get("fx") or () if f in ("super", "sub")), None)
    if script:
        tag = "sup" if script == "super" else "sub"
        out = f"<{tag}>{out}</{tag}>"
    for flag, tag in reversed(_TAGS):
        if flag in s and not (flag == "u" and t == "link"):
            out = f"<{tag}>{out}</{tag}>"
    css = _css(a, s)
    return f'<span style="{escape(css)}">{out}</span>' if css else out


def _par_css(a: dict) -> str:
    parts = []
    align = {"full": "justify"}.get(a.get("align"), a.get("align"))
    if align in ("left", "center", "right", "justify"):
        parts.append(f"text-align: {align};")
    try:
        if a.get("spaceafter"):
            parts.append(f"margin-bottom: {max(0.0, float(a['spaceafter']) - 1) * 0.8:g}em;")
    except (TypeError, ValueError):
        pass
    return " ".join(parts)


def _par(block: dict, options: dict, tag: str = "p") -> str:
    css = _par_css(block["a"])
    attrs = (f' class="{block["indent"]}"' if block["indent"] and tag == "p" else "") + (f' style="{css}"' if css else "")
    return f"<{tag}{attrs}>{''.join(_inline(r, options) for r in block['inline'])}{'<br>' * block['breaks']}</{tag}>"


def _table(block: dict, options: dict, state: dict) -> str:
    a = block["attributes"]
    width = {"fitmargins": "width: 100%;", "fixedleft": "width: auto;"}.get(a.get("widthtype"), "")
    cols = "".join(f'<col style="width: {escape(str(c["width"]))}">' if c.get("width") else "<col>" for c in block["columns"] if isinstance(c, dict))
    rows = []
    for row in block["rows"]:
        cells = []
        for c in row["cells"]:
            style = c.get("style") if isinstance(c.get("style"), dict) else {}
            attrs = "".join(f' {k}="{int(v)}"' for k in ("colspan", "rowspan") for v in [c.get(k) or style.get(k)] if str(v).isdigit() and int(v) > 1)
            ground = style.get("bgcolor") or (style.get("style") or {}).get("bgcolor")
            attrs += f' style="background-color: {escape(str(ground))};"' if ground else ""
            cells.append(f"<td{attrs}>{_blocks(c['blocks'], options, state)}</td>")
        rows.append((row["attributes"].get("tablabel"), "".join(cells)))
    if a.get("rowdisplay") == "tabs":
        state["tabs"] += 1
        n = state["tabs"]
        tabs = "".join(f'<input type="radio" name="tabs-{n}" id="tab-{n}-{i}"{" checked" if not i else ""}><label for="tab-{n}-{i}">{escape(label or f"Tab {i + 1}")}</label><div class="panel"><table><tr>{cells}</tr></table></div>' for i, (label, cells) in enumerate(rows))
        return f'<div class="tabs">{tabs}</div>'
    body = "".join(f"<tr>{cells}</tr>" for _, cells in rows)
    return f'<table style="border-collapse: collapse; {width}">{f"<colgroup>{cols}</colgroup>" if cols else ""}{body}</table>'


def _blocks(items: list[dict], options: dict, state: dict) -> str:
    out = []
    for b in items:
        kind = b["kind"]
        if kind == "p":
            out.append(_par(b, options))
        elif kind == "list":
            ol = _OL.get(b["type"])
            out.append((f'<ol type="{ol}">' if ol else "<ul>") + "".join(_par(i, options, "li") for i in b["items"]) + ("</ol>" if ol else "</ul>"))
        elif kind == "hr":
            out.append("<hr>")
        elif kind == "section":
            title = "".join(_inline(r, options) for p in b["title"] if p["kind"] == "p" for r in p["inline"])
            out.append(f"<details{' open' if b['attributes'].get('expanded') == 'true' else ''}><summary>{title}</summary>{_blocks(b['body'], options, state)}</details>")
        else:
            out.append(_table(b, options, state))
    return "".join(out)


def render(doc: dict, lang: str = "en", **options) -> str:
    """The page of a document: heading, body, appendix; an error page where the document is one."""
    meta = doc.get("meta") or {}
    title = heading(doc)
    if meta.get("error"):
        main = f'<h1>Render Error</h1><pre>{escape(str(meta["error"]))}</pre>'
    else:
        main = f"<h1>{escape(title)}</h1>" + _blocks(list(bodies(doc)), options, {"tabs": 0})
        rows = appendix(doc, 200, " …")
        if rows:
            body = "".join(f'<tr><th scope="row">{escape(r["name"])}</th><td>{escape(r["type"])}</td><td>{escape(r["preview"])}</td></tr>' for r in rows)
            main += f'<h2>Appendix</h2><table><caption>Other items</caption>{body}</table>'
    return f'<!DOCTYPE html><html lang="{escape(lang)}"><head><meta charset="utf-8"><title>{escape(title)}</title><style>{CSS}</style></head><body><a class="skip" href="#main">Skip to content</a><main id="main">{main}</main></body></html>'
