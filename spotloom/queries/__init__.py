"""Every operator bound to the given tables."""

from ..registry import ORACLES, QUERIES
from . import assign, exports, expression, imaging, merging, neighbours, quality, regions, space, summary  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
