"""Runs of a normalized document to blocks: paragraphs, lists, tables, sections, rules.

Both renderers read blocks, so what a paragraph or a list is gets decided once. Blank paragraphs become one line break
on the block before; consecutive list paragraphs of one kind are one list.
"""

from __future__ import annotations


def _indent(margin) -> str:
    """As ``functions.text.indent_class``: a margin without a unit is none."""
    text = str(margin or "").strip()
    try:
        inches = float(text[:-2]) / (72 if text.endswith("pt") else 1) if text.endswith(("in", "pt")) else 0.0
    except ValueError:
        return ""
    return "indent-3" if inches >= 1.75 else "indent-2" if inches >= 1.25 else "indent-1" if inches >= 0.75 else ""


def blocks(runs: list[dict]) -> list[dict]:
    out: list[dict] = []
    current: dict | None = None

    def close() -> None:
        nonlocal current
        if current is None:
            return
        if current["inline"] and current["inline"][0]["t"] == "text":
            first = dict(current["inline"][0])
            first["text"] = first.get("text", "").lstrip("  　")
            current["inline"] = ([first] if first["text"] else []) + current["inline"][1:]
        kind = (current["a"].get("list") or {}).get("type") if isinstance(current["a"].get("list"), dict) else None
        if not current["inline"]:
            if out and out[-1]["kind"] == "p":
                out[-1]["breaks"] = 1
        elif kind:
            if out and out[-1]["kind"] == "list" and out[-1]["type"] == kind:
                out[-1]["items"].append(current)
            else:
                out.append({"kind": "list", "type": kind, "items": [current]})
        else:
            out.append(current)
        current = None

    for run in runs or ():
        if not isinstance(run, dict):
            continue
        t = run.get("t")
        if t == "par":
            close()
            a = run.get("a") or {}
            current = {"kind": "p", "a": a, "inline": [], "indent": _indent(a.get("leftmargin")), "breaks": 0}
        elif t == "table":
            close()
            rows = run.get("rows") or []
            out.append({"kind": "table", "attributes": run.get("attributes") or {}, "columns": run.get("columns") or [], "rows": [{"attributes": r.get("attributes") or {}, "cells": [{**c, "blocks": blocks(c.get("runs") or [])} for c in r.get("cells") or [] if isinstance(c, dict)]} for r in (rows if isinstance(rows, list) else [rows]) if isinstance(r, dict)]})
        elif t == "section":
            close()
            out.append({"kind": "section", "title": blocks(run.get("title_runs") or []), "body": blocks(run.get("body_runs") or []), "attributes": run.get("attributes") or {}})
        elif t == "hr":
            close()
            out.append({"kind": "hr", "a": run.get("a") or {}})
        else:
            if current is None:
                current = {"kind": "p", "a": {}, "inline": [], "indent": "", "breaks": 0}
            current["inline"].append(run)
    close()
    return out


def appendix(doc: dict, most: int, more: str) -> list[dict]:
    """Items that the document itself doesn't show: name, type, preview, by lower-case name."""
    layout = doc.get("layout") or {}
    hidden = {*(layout.get("primary_fields_allowlist") or ()), *(layout.get("used_in_body") or ())}
    rows = []
    for name, item in (doc.get("fields") or {}).items():
        if name in hidden or name.startswith("$") or not isinstance(item, dict):
            continue
        value = item.get("value")
        if item.get("type") == "richtext":
            text = item.get("text") or "[RichText]"
        elif isinstance(value, list):
            text = ", ".join(map(str, value[:5])) + (more if len(value) > 5 else "")
        elif isinstance(value, dict):
            text = "{…}"
        else:
            text = "" if value is None else str(value)
        rows.append({"name": name, "type": item.get("type", "unknown"), "preview": text[:most] + more if len(text) > most else text})
    return sorted(rows, key=lambda r: r["name"].lower())


def heading(doc: dict) -> str:
    value = ((doc.get("fields") or {}).get("Subject") or {}).get("value")
    text = " ".join(map(str, value)) if isinstance(value, list) else "" if value is None else str(value)
    return text.strip() or f"NoTitle_{(doc.get('meta') or {}).get('unid')}"


def bodies(doc: dict):
    """Blocks of every rich-text item in order."""
    for item in (doc.get("fields") or {}).values():
        if isinstance(item, dict) and item.get("runs"):
            yield from blocks(item["runs"] if isinstance(item["runs"], list) else [item["runs"]])
