"""Whole conversions and comparisons composed from the operators."""
