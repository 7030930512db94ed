"""corvane: a Spark-native engine for curating and evaluating annotated corpora."""

__version__ = "0.1.0"
