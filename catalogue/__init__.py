"""Queries over the test tables, their inputs, and the SQL they are checked against."""
