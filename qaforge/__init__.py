"""qaforge: a Spark-first engine for building and auditing question-answering training data."""

__version__ = "0.1.0"
