"""Whole-project conversions and loads, composed from the operators."""
