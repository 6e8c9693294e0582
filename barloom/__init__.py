"""Barloom: equity indicators, ranking and backtests as Spark DataFrame plans."""
