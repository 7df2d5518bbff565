"""concordat: a Spark-native engine that reconciles lists describing the same things."""

__version__ = "0.1.0"
