"""Keyed energy time series on Spark: alignment, features, history upkeep and forecasts."""
