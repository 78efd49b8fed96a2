"""Scalar expressions, JSON parsing and tokenising."""
