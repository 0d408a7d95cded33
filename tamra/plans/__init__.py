"""Named queries over the given tables, each with its SQL where SQL can say it."""

from tamra.plans import blocks, cleaning, evaluation, flow, intake, personal, retrieval, talk, thai  # noqa: F401
from tamra.plans.registry import QUERIES

__all__ = ["QUERIES"]
