"""Streaming forms: keyed state, interval joins and running queries."""
