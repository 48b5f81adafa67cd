"""Labelled-text analytics on Spark: tables, text features, splits, models, metrics."""
