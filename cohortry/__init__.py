"""Cohort analytics on Spark: intervals, sample-by-feature matrices, quality scoring and study power."""
