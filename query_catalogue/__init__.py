"""Every registered query with the SQL that must give the same rows."""

from query_catalogue import (  # noqa: F401  (importing registers)
    edits_and_filters,
    genes_and_terms,
    matrix_and_quality,
    models_and_plans,
    records_and_subsets,
    sources_and_lookups,
)
from query_catalogue.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
