"""Whole jobs composed from the operators (one logical plan each)."""
