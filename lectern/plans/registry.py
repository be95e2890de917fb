"""All queries of the core, with their SQL."""

from __future__ import annotations

from lectern.plans import intervals, lessons, manifest, points, search, state, terms, transcripts

_MODULES = [intervals, manifest, transcripts, terms, search, state, lessons, points]


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.ORACLE.items()}
