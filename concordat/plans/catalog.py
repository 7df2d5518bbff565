"""All queries: importing this module registers every one of them."""

from . import characterisation, layers, lists, merging, queries, releases, review  # noqa: F401
from .queries import entry
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "entry"]
