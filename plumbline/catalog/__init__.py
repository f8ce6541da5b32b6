"""The registered queries and the SQL that checks them."""

from plumbline.catalog import encoders, facts, images, jobs, models, relational, rules, scores  # noqa: F401
from plumbline.catalog.registry import QUERIES

__all__ = ["QUERIES"]
