"""termloom: a PySpark-native engine for building and querying term knowledge bases."""

__version__ = "0.1.0"
