"""flightmart — a Spark-native flight-performance warehouse load."""

__version__ = "0.1.0"
