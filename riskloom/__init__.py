"""Relational feature engineering, out-of-fold scoring and score serving on Spark DataFrames."""
