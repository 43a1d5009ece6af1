"""Importing the modules registers their queries."""

from shelfline.queries import batch, feeds, figures, files, jobs  # noqa: F401
from shelfline.queries.registry import QUERIES

__all__ = ["QUERIES"]
