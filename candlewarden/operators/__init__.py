"""Data-quality operators: DataFrame in, DataFrame out, keyed by (symbol, timeframe)."""
