"""All queries, registered by importing their modules."""

from tidemirror.catalog import control, intake, loads, merging, reading, shaping, streams  # noqa: F401
from tidemirror.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
