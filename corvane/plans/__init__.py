"""Operator chains declared as data."""
