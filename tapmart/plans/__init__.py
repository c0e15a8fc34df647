"""Whole loads and star schemas, composed of the operators."""
