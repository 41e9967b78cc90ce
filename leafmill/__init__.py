"""leafmill: a PySpark-native document-intelligence and retrieval engine."""

__version__ = "0.1.0"
