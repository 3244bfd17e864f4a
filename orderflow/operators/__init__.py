"""Operators over DataFrames: parse, validate, enrich, flatten, aggregate, reconcile."""
