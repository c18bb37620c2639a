"""Whole jobs and the registry of queries on the test tables."""
