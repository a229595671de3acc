"""Operators for training data: whole documents, pages and vectors in, Spark DataFrames out."""
