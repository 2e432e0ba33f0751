"""A PySpark-native engine for building and auditing web text corpora."""

__version__ = "0.1.0"
