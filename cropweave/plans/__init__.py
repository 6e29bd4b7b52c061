"""Whole flows composed of operators: the user-level entry points."""
