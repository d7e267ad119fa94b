"""Spark-native engine for frozen map snapshots."""

from terrafold.workspace import attach

__all__ = ["attach"]
