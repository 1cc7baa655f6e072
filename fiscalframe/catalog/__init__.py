"""Registered queries and the plain SQL that must give the same rows."""

from __future__ import annotations

from fiscalframe.catalog import answers, collecting, receipts, repairs

_PARTS = (receipts, repairs, answers, collecting)

QUERIES = {name: fn for part in _PARTS for name, fn in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
