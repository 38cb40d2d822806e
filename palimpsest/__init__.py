"""palimpsest: a Spark-native engine for the history of lists seen through dated snapshots."""

__version__ = "0.1.0"
