"""Registered queries of the catalogue engine and their DuckDB SQL."""

from __future__ import annotations

from . import catalogue, content, records, runs

QUERIES = catalogue.query.queries | content.query.queries | records.query.queries | runs.query.queries
ORACLES = catalogue.query.oracles | content.query.oracles | records.query.oracles | runs.query.oracles
