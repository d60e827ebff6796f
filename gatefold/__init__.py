"""Cohort event analytics on Spark: gates, populations and per-sample statistics as DataFrame operators."""
