"""All registered queries."""

from __future__ import annotations

from doctables.plans import corpus, files, markdown, parameters, spreadsheet

_MODULES = [spreadsheet, markdown, parameters, corpus, files]

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
