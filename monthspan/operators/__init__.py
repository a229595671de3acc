"""Operators: DataFrame in, DataFrame out, chained with ``DataFrame.transform``."""
