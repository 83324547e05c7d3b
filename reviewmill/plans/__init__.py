"""Registered queries and their SQL."""

from . import fields, harvests, operations  # noqa: F401
from .queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
