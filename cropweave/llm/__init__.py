"""Operators of a training-data pipeline, and the queries that apply them to whole tables."""

from cropweave.llm import queries  # noqa: F401
from cropweave.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
