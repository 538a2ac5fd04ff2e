"""Candle (OHLC bar) data quality as Spark jobs over many series at once."""

__version__ = "0.1.0"
