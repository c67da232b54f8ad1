"""All registered queries of the toolkit and the SQL that gives the same rows in DuckDB."""

from __future__ import annotations

from collections.abc import Callable


def _modules() -> list:
    from . import companies, files, texts

    return [companies, files, texts]


def queries() -> dict[str, Callable]:
    return {name: q for m in _modules() for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
