"""Registered queries over the driver's tables, and the DuckDB SQL of each."""

from __future__ import annotations

from assayframe.plans import composed, core, more, pooled

QUERIES = {**core.QUERIES, **pooled.QUERIES, **composed.QUERIES, **more.QUERIES}
ORACLE_SQL = {**core.ORACLE_SQL, **pooled.ORACLE_SQL, **composed.ORACLE_SQL, **more.ORACLE_SQL}
