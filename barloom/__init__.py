"""Market bars, screens, fundamentals and data checks as Spark DataFrame functions."""

__version__ = "0.1.0"
