"""Operators: ``DataFrame -> DataFrame``, built from joins, aggregates and windows."""
