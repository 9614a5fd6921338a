"""All queries over the driver's tables, by key, with their independent oracle SQL."""

from __future__ import annotations

from . import assignment_queries, call_queries, calling_queries, catalog_queries, evidence_queries, gapped_queries, job_queries, quality_queries, rescue_queries, review_queries, seed_queries, sequence_queries, shape_queries, source_queries, tract_queries

MODULES = (source_queries, sequence_queries, catalog_queries, assignment_queries, calling_queries, evidence_queries, job_queries, rescue_queries, review_queries, quality_queries, shape_queries, tract_queries, call_queries, gapped_queries, seed_queries)


def queries() -> dict:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
