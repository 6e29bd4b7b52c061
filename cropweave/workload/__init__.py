"""Queries over the shared test tables, one per operator, each with equivalent SQL."""

from cropweave.workload import (  # noqa: F401
    cleaning, context, duplicates, extraction, matching, profiling, quality, reporting, storing)
from cropweave.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
