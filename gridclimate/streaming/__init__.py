"""Structured Streaming jobs that feed the observation store."""
