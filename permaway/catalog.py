"""The registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from permaway.plans import joins, meshing, rail, scalar, stores

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _m in (scalar, joins, rail, meshing, stores):
    QUERIES |= _m.QUERIES
    SQL |= _m.SQL
