"""All queries of all families in one place."""

from __future__ import annotations

from tablewarden.plans import (
    source_queries,
    run_queries,
    text_queries,
    stage_queries,
    match_queries,
    folder_queries,
    metric_queries,
    profile_queries,
)

FAMILIES = [
    profile_queries.FAMILY,
    run_queries.FAMILY,
    text_queries.FAMILY,
    stage_queries.FAMILY,
    source_queries.FAMILY,
    match_queries.FAMILY,
    folder_queries.FAMILY,
    metric_queries.FAMILY,
]
QUERIES = {name: q for family in FAMILIES for name, q in family.queries.items()}
ORACLES = {name: sql for family in FAMILIES for name, sql in family.oracles.items()}
