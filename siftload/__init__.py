"""siftload: batch extract, decode, classify and load jobs as PySpark DataFrame plans."""

__version__ = "0.1.0"
