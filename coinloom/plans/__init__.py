"""Queries over the driver tables."""

from . import queries, incremental, files  # noqa: E402, F401, I001
