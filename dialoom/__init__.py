"""A Spark-native engine for building, auditing and scoring tool-calling conversation corpora."""

from dialoom.ship import ship

__all__ = ["ship"]
