"""Named queries over the driver's tables, and SQL that gives the same rows."""

from __future__ import annotations

from . import evidence, identity, joins, layout, quality, records, storage, text, timeline

_MODULES = (evidence, joins, identity, text, quality, layout, timeline, records, storage)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLE_SQL = {k: v for m in _MODULES for k, v in m.ORACLE_SQL.items()}
