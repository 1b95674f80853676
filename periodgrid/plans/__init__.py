"""Whole refreshes built from the operators."""
