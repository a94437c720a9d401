"""tidelake: a Spark-native market-data feature engine."""

__version__ = "0.1.0"
