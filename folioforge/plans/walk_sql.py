"""The walk over nested records in SQL, written from the data's definition: what the queries over nodes are checked with."""

from __future__ import annotations


def _opened(x: str) -> str:
    return rf"(CASE WHEN json_type({x}) = 'VARCHAR' AND regexp_matches({x} ->> '$', '^[\x{{FEFF}} \t\r\n]*[\{{\[]') THEN coalesce(try_cast(regexp_replace({x} ->> '$', '^\x{{FEFF}}+', '') AS JSON), {x}) ELSE {x} END)"


def _entries(x: str) -> str:
    return f"(CASE json_type({_opened(x)}) WHEN 'ARRAY' THEN json_extract({_opened(x)}, '$[*]') WHEN 'OBJECT' THEN [{_opened(x)}] ELSE [] END)"


_ROOT = "(json_exists(j, '$.fields') OR json_exists(j, '$.attachments') OR json_exists(j, '$.layout'))"

NODES = rf"""WITH RECURSIVE texts AS (SELECT record_id, try_cast(regexp_replace(payload, '^\x{{FEFF}}+', '') AS JSON) AS j FROM raw_records WHERE payload IS NOT NULL),
env AS (
  SELECT record_id, 0 AS lvl, [0] AS pos, j FROM texts WHERE json_type(j) = 'OBJECT'
  UNION ALL
  SELECT record_id, lvl + 1, list_append(pos, i), {_opened("kid")} FROM (
    SELECT record_id, lvl, pos, unnest(kids) AS kid, unnest(range(len(kids))) AS i FROM (
      SELECT record_id, lvl, pos, CASE json_type(j) WHEN 'OBJECT' THEN json_extract(j, '$.*') ELSE json_extract(j, '$[*]') END AS kids FROM env
      WHERE json_type(j) IN ('OBJECT', 'ARRAY') AND NOT (json_type(j) = 'OBJECT' AND {_ROOT})))
),
docs AS (
  SELECT record_id, j FROM env WHERE json_type(j) = 'OBJECT' AND {_ROOT}
  QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY lvl, pos) = 1
),
top AS (
  SELECT record_id, 'fields' AS part, unnest(json_keys(f)) AS name, unnest(range(len(json_keys(f)))) AS i, unnest(json_extract(f, '$.*')) AS v FROM (SELECT record_id, {_opened("json_extract(j, '$.fields')")} AS f FROM docs) WHERE json_type(f) = 'OBJECT'
  UNION ALL
  SELECT record_id, 'attachments', '', unnest(range(len(a))), unnest(a) FROM (SELECT record_id, {_entries("json_extract(j, '$.attachments')")} AS a FROM docs)
  UNION ALL
  SELECT record_id, 'layout', name, unnest(range(len(a))), unnest(a) FROM (
    SELECT record_id, name, {_entries("v")} AS a FROM (SELECT record_id, unnest(json_keys(f)) AS name, unnest(json_extract(f, '$.*')) AS v FROM (SELECT record_id, {_opened("json_extract(j, '$.layout')")} AS f FROM docs) WHERE json_type(f) = 'OBJECT'))
),
walk AS (
  SELECT record_id, CASE part WHEN 'fields' THEN 'fields.' || name WHEN 'attachments' THEN 'attachments[' || i || ']' ELSE 'layout.' || name || '[' || i || ']' END AS path, '$' AS parent, [i::INT] AS dewey, 1 AS depth,
    CASE part WHEN 'layout' THEN 'layout.' || regexp_replace(name, '\[\d+\]', '', 'g') ELSE part END AS tab, '' AS gap, true AS node, part = 'fields' AS opens, CASE WHEN part = 'fields' THEN {_opened("v")} ELSE v END AS v
  FROM top WHERE json_type(v) <> 'NULL' AND (part <> 'attachments' OR json_type(v) = 'OBJECT')
  UNION ALL
  SELECT record_id, CASE WHEN node THEN path || gap || step ELSE path END, CASE WHEN node THEN path ELSE parent END, CASE WHEN node THEN list_append(dewey, i::INT) ELSE dewey END, depth + node::INT,
    CASE WHEN node THEN tab || regexp_replace(gap || step, '\[\d+\]', '', 'g') ELSE tab END, CASE WHEN node THEN '' ELSE gap || step END, node, true, kid FROM (
    SELECT *, json_type(kid) = 'OBJECT' AND listed AS node FROM (
      SELECT record_id, path, parent, dewey, depth, tab, gap, listed, CASE WHEN key = '' THEN '' ELSE '.' || key END || CASE WHEN num THEN '[' || i || ']' ELSE '' END AS step, i, kid FROM (
        SELECT record_id, path, parent, dewey, depth, tab, gap, key, listed, num, unnest(kids) AS kid, unnest(range(len(kids))) AS i FROM (
          SELECT record_id, path, parent, dewey, depth, tab, gap, '' AS key, false AS listed, true AS num, json_extract(v, '$[*]') AS kids FROM walk WHERE opens AND json_type(v) = 'ARRAY'
          UNION ALL
          SELECT record_id, path, parent, dewey, depth, tab, gap, key, listed, listed, CASE WHEN listed THEN {_entries("kid")} ELSE [kid] END FROM (
            SELECT record_id, path, parent, dewey, depth, tab, gap, key, kid, key IN ('runs', 'rows', 'cells', 'columns', 'title_runs', 'body_runs') AS listed FROM (
              SELECT record_id, path, parent, dewey, depth, tab, gap, unnest(json_keys(v)) AS key, unnest(json_extract(v, '$.*')) AS kid FROM walk WHERE opens AND json_type(v) = 'OBJECT')))))
    WHERE json_type(kid) IN ('OBJECT', 'ARRAY'))
),
nodes AS (SELECT record_id, path AS node_path, parent AS parent_path, dewey, depth, tab AS "table", v FROM walk WHERE node)"""

TOKENS = NODES + r""",
toks AS (
  SELECT record_id, node_path, parent_path, dewey, regexp_extract(node_path, '^fields\.(.+?)\.(?:runs|title_runs|body_runs|rows)\[', 1) AS field, regexp_extract("table", '([^.]+)$', 1) AS slot, v,
    v ->> '$.t' AS t, v ->> '$.text' AS text, v ->> '$.label' AS label, v ->> '$.href' AS href, v ->> '$.name' AS name, v ->> '$.displayname' AS displayname, v ->> '$.alt' AS alt, v ->> '$.s' AS s, v ->> '$.a' AS a
  FROM nodes WHERE starts_with("table", 'fields') AND regexp_extract("table", '([^.]+)$', 1) IN ('runs', 'title_runs', 'body_runs'))
"""
