"""Spark-native engine for gridded weather and solar observations."""

from gridclimate.session import build_session

__all__ = ["build_session"]
