import json

from folioforge.operators import nested


def rows(spark, *payloads):
    df = spark.createDataFrame([(i, p, "x") for i, p in enumerate(payloads, 1)], "record_id long, payload string, node_path string")
    return {(r["record_id"], r["node_path"], r["parent_path"]) for r in nested.found(df).collect()}


def doc(**more):
    return {"schema_version": "1", "meta": {}, "fields": {}} | more


def test_paths(spark):
    body = {"type": "richtext", "runs": [{"t": "par"}, None, {"t": "table", "rows": {"cells": [{"runs": json.dumps([{"t": "text"}])}, None, {"runs": {"t": "br"}}]}, "columns": [{}]}, {"t": "section", "title_runs": None, "body_runs": [{"t": "text", "a": {"x": 1}}]}]}
    d = doc(fields={"Body": body, "due at": {"type": "text", "value": "a"}, "Gone": None}, attachments=[None, {"name": "a"}], layout={"used_in_body": ["Body", None, "Subject"], "other": "x"})
    got = rows(spark, json.dumps(d))
    assert got == {
        (1, "fields.Body", "$"), (1, "fields.Body.runs[0]", "fields.Body"), (1, "fields.Body.runs[2]", "fields.Body"), (1, "fields.Body.runs[2].rows[0]", "fields.Body.runs[2]"),
        (1, "fields.Body.runs[2].rows[0].cells[0]", "fields.Body.runs[2].rows[0]"), (1, "fields.Body.runs[2].rows[0].cells[0].runs[0]", "fields.Body.runs[2].rows[0].cells[0]"),
        (1, "fields.Body.runs[2].rows[0].cells[2]", "fields.Body.runs[2].rows[0]"), (1, "fields.Body.runs[2].rows[0].cells[2].runs[0]", "fields.Body.runs[2].rows[0].cells[2]"),
        (1, "fields.Body.runs[2].columns[0]", "fields.Body.runs[2]"), (1, "fields.Body.runs[3]", "fields.Body"), (1, "fields.Body.runs[3].body_runs[0]", "fields.Body.runs[3]"),
        (1, "fields.due at", "$"), (1, "attachments[1]", "$"), (1, "layout.used_in_body[0]", "$"), (1, "layout.used_in_body[2]", "$"),
    }


def test_forms_of_delivery(spark):
    d = doc(fields={"A": {"value": "x"}}, attachments=json.dumps([{"name": "z"}]))
    text = json.dumps(d)
    one = {("fields.A", "$"), ("attachments[0]", "$")}
    got = rows(spark, "﻿" + text, json.dumps({"doc": d}), json.dumps({"x": 1, "normalized": d}), text[:-5], "[1]", "", None, '"x"', json.dumps({"doc": {"payload": text}}))
    assert got == {(i, *p) for i in (1, 2, 3, 9) for p in one}
    lone = rows(spark, json.dumps(doc(attachments={"name": "z"})))
    assert lone == {(1, "attachments[0]", "$")}


def test_deep_and_long(spark):
    run = {"t": "text", "text": "x" * 300_000}
    for _ in range(150):
        run = {"t": "section", "title_runs": [], "body_runs": [run]}
    got = rows(spark, json.dumps(doc(fields={"Body": {"runs": [run]}})))
    assert len(got) == 152 and max(len(p.split(".")) for _, p, _ in got) == 153


def test_parents_exist_and_tables(spark):
    d = doc(fields={"Body": {"type": "richtext", "runs": [{"t": "table", "rows": [{"cells": [{"colspan": "2", "runs": []}]}]}]}})
    df = spark.createDataFrame([(1, json.dumps(d)), (1, json.dumps(d))], "record_id long, payload string")
    flat = nested.flatten(df).collect()
    paths = {r["node_path"] for r in flat} | {"$"}
    assert all(r["parent_path"] in paths for r in flat)
    kinds = {r["kind"]: r["colspan"] for r in nested.tables(nested.flatten(df)).collect()}
    assert kinds == {"fields": None, "runs": None, "rows": None, "cells": 2}
    assert nested.found(df.limit(0)).count() == 0


def test_lists_at_every_level_and_many_envelopes(spark):
    cell = {"cells": [{"runs": []}]}
    d = doc(fields={"Body": [{"runs": [{"t": "par"}]}, None, [{"rows": cell}]], "Text": json.dumps([{"runs": {"t": "br"}}]), "Odd": {"runs": [[{"runs": [{}]}], {"x": [[{"rows": [{}]}]]}]}})
    text = json.dumps(d)
    wrapped = d
    for _ in range(30):
        wrapped = {"doc": wrapped}
    want = {
        ("fields.Body", "$"), ("fields.Body[0].runs[0]", "fields.Body"), ("fields.Body[2][0].rows[0]", "fields.Body"), ("fields.Body[2][0].rows[0].cells[0]", "fields.Body[2][0].rows[0]"),
        ("fields.Text", "$"), ("fields.Text[0].runs[0]", "fields.Text"), ("fields.Odd", "$"), ("fields.Odd.runs[0][0].runs[0]", "fields.Odd"),
        ("fields.Odd.runs[1]", "fields.Odd"), ("fields.Odd.runs[1].x[0][0].rows[0]", "fields.Odd.runs[1]"),
    }
    assert rows(spark, text, json.dumps(wrapped)) == {(i, *p) for i in (1, 2) for p in want}


def test_depth_is_not_bounded(spark):
    """100,000 lists in each other, 3,000 sections in each other, and the same in an envelope; the readers agree."""
    n = 100_000
    lists = '{"fields": {"A": {"value": ' + "[" * n + '{"runs": [{"t": "br"}]}' + "]" * n + "}}}"
    sections = '{"fields": {"B": {"runs": [' + '{"t": "section", "body_runs": [' * 3000 + '{"t": "br"}' + "]}" * 3000 + "]}}}"
    wrapped = '{"a": ' * 20_000 + lists + "}" * 20_000
    got = rows(spark, lists, sections, wrapped, lists[:-1], "[" * n)
    deep = {(i, len(a), b) for i, a, b in got if i in (1, 3)}
    assert deep == {(i, *x) for i in (1, 3) for x in ((8, "$"), (8 + 6 + 3 * n + 8, "fields.A"))}
    assert sum(i == 2 for i, *_ in got) == 3002 and not any(i in (4, 5) for i, *_ in got)


def test_iterative_reader_and_writer():
    texts = ['{"a": [1, -2.5e3, true, null, "x\\u00e9\\n"], "b": {}, "c": [], "a": 2}', " [ ] ", "3", '"x"', "[1,]", "[1 2]", '{"a" 1}', '{"a": 1,}', "{", "]", "", "[1] 2", "nul", "01", '{1: 2}', "[[{}], [{}, []]]"]
    for text in texts:
        try:
            want = json.loads(text)
        except ValueError:
            want = ValueError
        try:
            got = nested._loads_deep(text)
        except ValueError:
            got = ValueError
        assert got == want, text
    deep = value = []
    for _ in range(50_000):
        value.append({"k": [1, "x"], "runs": []})
        value[0]["v"] = value = []
    text = nested.dumps(deep)
    assert text == nested.dumps(nested.loads(text)) and text.startswith('[{"k": [1, "x"], "runs": [], "v": [')


def test_envelopes_with_other_keys_and_unreadable_payloads(spark):
    d = doc(fields={"A": {"value": "x"}})
    df = spark.createDataFrame([(1, json.dumps({"n": 1, "meta": {"by": "x"}, "body": {"seq": 2, "doc": [{"kind": "note", "data": json.dumps(d)}]}})), (2, "{"), (3, None), (4, "[]"), (5, "{}")], "record_id long, payload string")
    assert {tuple(r) for r in nested.found(df).collect()} == {(1, "fields.A", "$")}
    assert {tuple(r) for r in nested.report(df).collect()} == {("fields", 1, 1, 1), (nested.UNREADABLE, 0, 3, 0)}
