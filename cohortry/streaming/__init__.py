"""Queries over streams of events (an addition to the batch operators)."""
