"""Whole migration jobs, composed of the operators."""
