"""Importing this module registers every query."""

from threadloom.plans import (  # noqa: F401
    dialogue_queries,
    media_queries,
    relational_queries,
    retrieval_queries,
    text_queries,
)
from threadloom.plans.registry import ORACLES, QUERIES  # noqa: F401
