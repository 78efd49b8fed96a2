"""A retail stream warehouse written with the public DataFrame, SQL and Structured Streaming API."""
