"""Registered queries, and the SQL that checks them in DuckDB."""

from frostline.catalog import (
    contracts, encoding, evaluation, features, profiling, runs, sampling, scoring, selection, synthesis, training,
)

_SECTIONS = [contracts, features, encoding, sampling, synthesis, profiling, selection, training, evaluation, scoring, runs]


def all_queries() -> dict:
    return {name: query for section in _SECTIONS for name, query in section.QUERIES.items()}


def all_checks() -> dict:
    return {name: sql for section in _SECTIONS for name, sql in section.CHECKS.items()}
