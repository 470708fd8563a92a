"""All queries of the core and their SQL."""

from __future__ import annotations

from folioforge.plans import documents, problems, rendering

QUERIES = {**problems.QUERIES, **documents.QUERIES, **rendering.QUERIES}
SQL = {**problems.SQL, **documents.SQL, **rendering.SQL}
