"""Registered queries: each operator over the given tables, with its SQL where one can be written."""

from queries import answers, cohorts, deltas, documents, enrichment, forms, scalars, storage  # noqa: F401
from queries.registry import QUERIES, SQL  # noqa: F401
