"""All core queries: importing this module fills the registry."""

from folioforge.plans import compaction, records, relational, streams  # noqa: F401
from folioforge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
