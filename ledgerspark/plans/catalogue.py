"""Every query of the library by name, with the SQL it is checked against."""

from __future__ import annotations

from . import analysis, audit, building, extraction, io, repairs  # noqa: F401 - they register their queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
