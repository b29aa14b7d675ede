"""Whole linkage runs, built of the operators."""
