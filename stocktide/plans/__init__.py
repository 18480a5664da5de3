"""Whole reports and runs, composed from the operators."""
