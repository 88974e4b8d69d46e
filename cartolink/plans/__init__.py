"""All queries of the library by name, and their SQL."""

from . import files, names, pages, search  # noqa: F401  register their queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
