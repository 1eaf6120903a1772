"""Structured Streaming sources, windows and exactly-once tables."""
