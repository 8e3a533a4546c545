"""Structured Streaming forms of the version rules, and windows over events."""
