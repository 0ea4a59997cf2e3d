"""Structured Streaming jobs. Every job takes any stream with a ``value`` column, so topics and files work alike."""
