"""Operators for preparing training data: dedup, quality, toxicity, mixing, search, packing.

Nothing else in the library imports this subpackage. Each operator takes and returns
DataFrames; ``queries`` holds the registered ``opN_<name>`` queries.
"""
