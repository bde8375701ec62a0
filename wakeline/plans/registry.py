"""Every named query with its SQL twin."""

from __future__ import annotations

from wakeline.plans import reports  # noqa: F401  its queries register themselves
from wakeline.plans.trajectory import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
