"""All queries of the engine by name, with the SQL that gives the same rows."""

from __future__ import annotations

from dialoom.plans import checks, dialogs, files, lookups, profile, rendering, scalar, scores, selection, streams, tally

_PARTS = (profile, selection, scalar, lookups, checks, tally, rendering, scores, streams, dialogs, files)

QUERIES = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in _PARTS for name, sql in part.ORACLE_SQL.items()}
