"""hushwire: a Spark-native engine for de-identifying transcribed speech and text."""

__version__ = "0.1.0"
