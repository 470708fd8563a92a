"""Rendering of many documents: one Arrow batch at a time, one row per document and format; errors are data."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators import nested
from folioforge.render import docx, html, md, pdf

FORMATS = {"html": html.render, "md": md.render}
BINARY = {"docx": docx.render, "pdf": pdf.render}


def _lists(doc):
    """Lone objects and JSON texts in list places as lists, at any depth of the fields."""
    todo = [(doc.get("fields") or {}, None)]
    while todo:
        node, _ = todo.pop()
        for k, v in list(node.items()) if isinstance(node, dict) else ():
            if k in nested.LISTS:
                v = node[k] = [x for x in nested._entries(v) if isinstance(x, dict)]
            todo += [(x, None) for x in (v if isinstance(v, list) else [v]) if isinstance(x, dict)]
    return doc


def render(records: DataFrame, formats: tuple[str, ...] = ("html",)) -> DataFrame:
    """record_id, format, output, error. A payload that is no document, or fails, gives an error and no output."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for record, payload, fmt in zip(pdf["record_id"], pdf["payload"], pdf["format"], strict=True):
                doc = nested.load(payload)
                try:
                    out.append((record, fmt, FORMATS[fmt](_lists(doc)), None) if doc else (record, fmt, None, "no document"))
                except Exception as e:  # noqa: BLE001 - one document must not end the job
                    out.append((record, fmt, None, f"{type(e).__name__}: {e}"[:400]))
            yield pd.DataFrame(out, columns=["record_id", "format", "output", "error"])

    return _each(records, formats).mapInPandas(run, "record_id long, format string, output string, error string")


def _each(records: DataFrame, formats: tuple[str, ...]) -> DataFrame:
    return records.select(F.col("record_id").cast("long").alias("record_id"), F.col("payload").cast("string").alias("payload"), F.explode(F.array(*map(F.lit, formats))).alias("format"))


def render_files(records: DataFrame, formats: tuple[str, ...] = ("html", "docx", "pdf")) -> DataFrame:
    """record_id, format, content (bytes), error: every format as a file's content."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf_ in batches:
            out = []
            for record, payload, fmt in zip(pdf_["record_id"], pdf_["payload"], pdf_["format"], strict=True):
                doc = nested.load(payload)
                try:
                    made = None if not doc else BINARY[fmt](_lists(doc)) if fmt in BINARY else FORMATS[fmt](_lists(doc)).encode("utf-8", "replace")
                    out.append((record, fmt, made, None if doc else "no document"))
                except Exception as e:  # noqa: BLE001 - one document must not end the job
                    out.append((record, fmt, None, f"{type(e).__name__}: {e}"[:400]))
            yield pd.DataFrame(out, columns=["record_id", "format", "content", "error"])

    return _each(records, formats).mapInPandas(run, "record_id long, format string, content binary, error string")


def text_of(doc: dict) -> str:
    return json.dumps(doc, ensure_ascii=False, indent=2)
