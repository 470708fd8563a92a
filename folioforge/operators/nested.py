"""Deeply nested records to related flat tables by Dewey labels.

A payload is walked once. Each node that is a case gets the label of its parent plus one step; a step is the slot it
hangs in and its position there. So the parent's label is the label without its last step, at any depth, and no node
has to carry its ancestors or be joined with them. Nodes with the same slots, positions left out, are one table.

Only the walk of a single payload is Python (Spark's types can't recurse); it is row-local and streams in Arrow
batches. Labels, parents and tables are JVM expressions. Nothing in the walk recurses, so neither the depth of a
payload nor the number of its envelopes is bounded; where the standard reader gives up, an iterative one takes over.

Defined results: a null, empty or incomplete payload, or one that is no object, gives no node and is counted in the
report; null entries keep their position and give none; a lone object stands for a list of one; a list given as JSON
text is that list; lists inside lists, and lists that a field consists of, are walked and give no nodes of their own;
any number of envelopes is opened, whatever else they hold: the document is the nearest object with fields, attachments
or layout, objects in lists and in JSON text included; of two equal keys of one object the last counts; records are told
apart by ``record_id``, so a repeated record gives its rows once per id.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.decoder import scanstring

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LISTS = ("runs", "rows", "cells", "columns", "title_runs", "body_runs")
#: What makes an object the document itself.
ROOT_KEYS = ("fields", "attachments", "layout")
NODE = "record_id long, slots array<string>, ordinals array<int>, table string, content string"
#: Table name of the one marker row of a payload that is no document.
UNREADABLE = "(unreadable)"
#: Nodes, and steps in their labels, that are handed over at once.
BATCH_NODES, BATCH_STEPS = 20_000, 1_000_000

_BLANK = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"true|false|null|NaN|-?Infinity|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?")


def loads(text: str):
    """The JSON value of a text of any depth; ValueError if it is none."""
    try:
        return json.loads(text)
    except RecursionError:
        return _loads_deep(text)


def _loads_deep(text: str):
    """``json.loads`` with a stack of its own: open containers, and the keys under which objects hang in them."""
    top: list = []
    open_, keys = [top], [None]
    at, n = _BLANK.match(text, 0).end(), len(text)
    expect = "value"  # value, first (or the end of the container), next (a comma or the end), key
    while at < n:
        own, c = open_[-1], text[at]
        if len(open_) == 1 and top:
            raise ValueError("extra data")
        if expect in ("first", "next") and c == ("}" if isinstance(own, dict) else "]") and len(open_) > 1:
            open_.pop()
            keys.pop()
            expect, at = "next", at + 1
        elif expect == "next":
            if c != ",":
                raise ValueError("no comma")
            expect, at = ("key" if isinstance(own, dict) else "value"), at + 1
        elif expect == "key" or (expect == "first" and isinstance(own, dict)):
            if c != '"':
                raise ValueError("no key")
            keys[-1], at = scanstring(text, at + 1)
            at = _BLANK.match(text, at).end()
            if text[at : at + 1] != ":":
                raise ValueError("no colon")
            expect, at = "value", at + 1
        else:
            if c in "{[":
                value = {} if c == "{" else []
                at += 1
            elif c == '"':
                value, at = scanstring(text, at + 1)
            elif m := _SCALAR.match(text, at):
                value, at = json.loads(m.group()), m.end()
            else:
                raise ValueError("no value")
            if isinstance(own, dict):
                own[keys[-1]] = value
            else:
                own.append(value)
            expect = "next"
            if c in "{[":
                open_.append(value)
                keys.append(None)
                expect = "first"
        at = _BLANK.match(text, at).end()
    if len(open_) > 1 or not top:
        raise ValueError("incomplete")
    return top[0]


def dumps(value) -> str:
    """JSON text of a value of any depth."""
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        pass
    out: list[str] = []
    todo: list = [(value, None)]
    while todo:
        x, text = todo.pop()
        if text is not None:
            out.append(text)
        elif isinstance(x, dict):
            todo.append((None, "}"))
            for k, (key, child) in reversed(list(enumerate(x.items()))):
                todo += [(child, None), (None, (", " if k else "") + json.dumps(key, ensure_ascii=False) + ": ")]
            out.append("{")
        elif isinstance(x, list):
            todo.append((None, "]"))
            for k, child in reversed(list(enumerate(x))):
                todo.append((child, None))
                if k:
                    todo.append((None, ", "))
            out.append("[")
        else:
            out.append(json.dumps(x, ensure_ascii=False))
    return "".join(out)


def load(payload: str | None) -> dict | None:
    """The normalized document in a payload, out of its envelopes; None if it is no complete JSON object."""
    if payload is None:
        return None
    try:
        doc = loads(payload.lstrip("\ufeff"))
    except ValueError:
        return None
    if not isinstance(doc, dict):
        return None
    level: list = [doc]
    while level:  # nearest first
        below: list = []
        for x in level:
            if isinstance(x, dict):
                if any(k in x for k in ROOT_KEYS):
                    return x
                below += [v for v in map(_opened, x.values()) if isinstance(v, dict | list)]
            else:
                below += [v for v in map(_opened, x) if isinstance(v, dict | list)]
        level = below
    return doc


def _opened(value):
    """JSON text of an object or a list as that value."""
    if isinstance(value, str) and value.lstrip("\ufeff \t\r\n")[:1] in ("{", "["):
        try:
            return loads(value.lstrip("\ufeff"))
        except ValueError:
            return value
    return value


def _entries(value) -> list:
    """What stands where a list should: the list, a list in text, or a lone object."""
    value = _opened(value)
    return value if isinstance(value, list) else [value] if isinstance(value, dict) else []


def _scalars(value) -> str | None:
    """The node's own values as JSON, without what becomes nodes of its own at any depth."""
    if isinstance(value, dict):
        value = {k: v for k, v in value.items() if k not in LISTS}
        deep = any(isinstance(v, dict | list) for v in value.values())
    else:
        deep = isinstance(value, list)
    return dumps(_bare(value) if deep else value)


def _bare(value):
    """A copy of objects and lists without the lists of nodes."""
    top: list = [None]
    todo = [(value, top, 0)]
    while todo:
        x, into, at = todo.pop()
        if isinstance(x, dict):
            own = into[at] = {k: v for k, v in x.items() if k not in LISTS}
        elif isinstance(x, list):
            own = into[at] = list(x)
        else:
            continue
        todo += [(v, own, k) for k, v in (own.items() if isinstance(own, dict) else enumerate(own)) if isinstance(v, dict | list)]
    return top[0]


def nodes(doc: dict) -> Iterator[tuple[list[str], list[int], str | None]]:
    """(slots, ordinals, content) of every node, parents first. Iterative: depth is bounded by memory only.

    A slot begins with what joins it to its parent, a dot or the position in a list. An entry of ``stack`` with a gap
    (the way from the node above) is no node of its own.
    """
    stack = []
    fields = _opened(doc.get("fields"))
    for k, (name, value) in enumerate(fields.items() if isinstance(fields, dict) else ()):
        if value is not None:
            stack.append(([f"fields.{name}"], [k], _opened(value) if isinstance(value, str) else value, None))
    for k, value in enumerate(_entries(doc.get("attachments"))):
        if isinstance(value, dict):
            yield [f"attachments[{k}]"], [k], _scalars(value)
    layout = _opened(doc.get("layout"))
    for name, values in layout.items() if isinstance(layout, dict) else ():
        for k, value in enumerate(_entries(values)):
            if value is not None:
                yield [f"layout.{name}[{k}]"], [k], dumps(value)
    stack.reverse()
    while stack:
        slots, ordinals, value, gap = stack.pop()
        if gap is None:
            yield slots, ordinals, _scalars(value)
            gap = ""
        below = []
        if isinstance(value, list):
            below = [(slots, ordinals, x, f"{gap}[{k}]") for k, x in enumerate(value) if isinstance(x, dict | list)]
        for key, child in value.items() if isinstance(value, dict) else ():
            if key in LISTS:
                for k, x in enumerate(_entries(child)):
                    if isinstance(x, dict):
                        below.append(([*slots, f"{gap}.{key}[{k}]"], [*ordinals, k], x, None))
                    elif isinstance(x, list):
                        below.append((slots, ordinals, x, f"{gap}.{key}[{k}]"))
            elif isinstance(child, dict | list):
                below.append((slots, ordinals, child, f"{gap}.{key}"))
        stack += reversed(below)


_AT = re.compile(r"\[\d+\]")


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    frame = lambda rows: pd.DataFrame(rows, columns=["record_id", "slots", "ordinals", "table", "content"])
    names: dict[str, str] = {}
    for pdf in batches:
        out, steps = [], 0
        for record, payload in zip(pdf["record_id"], pdf["payload"], strict=True):
            doc = load(payload)
            if doc is None:
                out.append((record, [], [], UNREADABLE, None))
                continue
            for slots, ordinals, content in nodes(doc):
                path = "".join(["fields", *slots[1:]] if slots[0].startswith("fields.") else slots)
                table = names.get(path)
                if table is None:
                    if len(names) > BATCH_NODES:
                        names.clear()
                    table = _AT.sub("", path)
                    if len(path) < 200:
                        names[path] = table
                out.append((record, slots, ordinals, table, content))
                steps += len(slots)
                if len(out) >= BATCH_NODES or steps >= BATCH_STEPS:
                    yield frame(out)
                    out, steps = [], 0
        yield frame(out)


def _path(slots: Column) -> Column:
    return F.array_join(slots, "")


def walked(records: DataFrame) -> DataFrame:
    """Nodes as slots and ordinals, with one marker row for each payload that is no document."""
    raw = records.select(F.col("record_id").cast("long").alias("record_id"), F.col("payload").cast("string").alias("payload"))
    return raw.mapInPandas(_walk, NODE)


def flatten(records: DataFrame) -> DataFrame:
    """All nodes of all records.

    Columns: record_id, node_path, parent_path (``$`` at the top), dewey (ordinals, sorts in document order),
    depth, table (path of the schema: positions and field names left out), content (the node's own values as JSON).
    """
    flat = walked(records).where(F.col("table") != UNREADABLE)
    depth = F.size("slots")
    parent = F.when(depth > 1, _path(F.slice("slots", 1, F.greatest(depth - 1, F.lit(1))))).otherwise(F.lit("$"))
    return flat.select("record_id", _path(F.col("slots")).alias("node_path"), parent.alias("parent_path"), F.col("ordinals").alias("dewey"), depth.alias("depth"), "table", "content")


def tables(flat: DataFrame) -> DataFrame:
    """The flat tables in one frame: a table each for fields, runs, rows, cells, columns, sections, attachments, layout.

    ``kind`` is the last slot of the schema path; typed columns are read from ``content`` and null where absent.
    """
    kind = F.regexp_extract("table", r"([^.]+)$", 1)
    value = lambda key: F.get_json_object("content", f"$.{key}")
    return flat.select(
        "record_id", "node_path", "parent_path", "dewey", "depth", "table",
        F.when(F.col("table").startswith("layout"), "layout").otherwise(kind).alias("kind"),
        value("t").alias("t"), value("type").alias("type"), value("name").alias("name"), value("text").alias("text"), value("value").alias("value"),
        value("size").try_cast("long").alias("size"), value("colspan").try_cast("int").alias("colspan"), value("rowspan").try_cast("int").alias("rowspan"), value("width").alias("width"), value("href").alias("href"), value("label").alias("label"),
    )


def report(records: DataFrame) -> DataFrame:
    """Rows, records and deepest level of each flat table, and a row that counts the payloads that are no document."""
    own = walked(records).select("table", "record_id", F.size("slots").alias("depth"))
    rows = F.count_if(F.col("table") != UNREADABLE)
    return own.groupBy("table").agg(rows.alias("n_rows"), F.countDistinct("record_id").alias("n_records"), F.max("depth").alias("max_depth"))


def found(records: DataFrame) -> DataFrame:
    """record_id, node_path and parent_path of every node."""
    return flatten(records).select("record_id", "node_path", "parent_path")
