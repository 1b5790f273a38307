"""Weighted population indicators, point-in-time features and target-risk studies on Spark DataFrames."""
