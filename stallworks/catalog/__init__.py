"""Every operator and report bound to the supplied tables, each with its SQL check.

``REGISTRY`` maps a query name to its Spark function and, where SQL can express it,
the equivalent statement. Names are the inventory identifiers in lower case.
"""

from __future__ import annotations

from .registry import REGISTRY
from . import scans, writes, projections, joins, aggregates, windows, scalars, checks, reports, trial  # noqa: F401

__all__ = ["REGISTRY"]
