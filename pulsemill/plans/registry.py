"""All registered queries and their comparison SQL."""

from __future__ import annotations

from pulsemill.plans import counters, delivery, histograms, points, spans, streams

_FAMILIES = (points, histograms, spans, counters, delivery, streams)

QUERIES = {name: query for family in _FAMILIES for name, query in family.QUERIES.items()}
SQL = {name: sql for family in _FAMILIES for name, sql in family.SQL.items()}
