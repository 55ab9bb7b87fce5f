"""pitlake: point-in-time market data as Spark DataFrame functions."""

__version__ = "0.1.0"
