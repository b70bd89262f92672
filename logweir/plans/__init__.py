"""Whole runs over log lines, and the queries over the test tables."""
