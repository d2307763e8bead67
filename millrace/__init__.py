"""millrace: a PySpark engine that curates question/answer corpora."""

__version__ = "0.1.0"
