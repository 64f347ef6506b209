"""Named queries over the given tables, one module per family."""

from quayside.plans import filtering, flagship, loading, planning, publishing, reading, reporting, scalars, scripting, shaping, surface  # noqa: F401
from quayside.plans.registry import QUERIES

__all__ = ["QUERIES"]
