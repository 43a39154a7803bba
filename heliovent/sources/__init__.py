"""Batch readers and writers over any Hadoop-compatible path."""
