"""Whole reports and daily jobs composed from the operators."""
