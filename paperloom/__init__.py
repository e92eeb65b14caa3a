"""paperloom: a Spark-native engine for sampling and processing scholarly works."""

__version__ = "0.1.0"
