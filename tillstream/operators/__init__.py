"""Filters, joins, per-key state and windows, each a function DataFrame -> DataFrame."""
