"""Structured Streaming: message topic to raw files."""
