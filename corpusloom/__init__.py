"""corpusloom: a Spark-native engine that builds and analyses text corpora."""

__version__ = "0.1.0"
