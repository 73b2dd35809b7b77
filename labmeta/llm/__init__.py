"""Operators for preparing training text: ten methods over whole document tables, and their registered queries."""

from labmeta.llm import queries  # noqa: F401
from labmeta.llm.registry import QUERIES, SQL  # noqa: F401
