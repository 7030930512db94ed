"""Relational, grouping and governance operators over DataFrames."""
