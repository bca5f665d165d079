"""All registered queries."""

from . import functions, monitoring, movement, quality, transforms  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
