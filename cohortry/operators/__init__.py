"""Operators on feature tables, intervals, quality metrics and provenance."""
