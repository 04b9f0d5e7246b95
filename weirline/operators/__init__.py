"""Operators on DataFrames: columns, routing, merging, aggregating, reshaping, schemas."""
