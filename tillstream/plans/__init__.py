"""The warehouse's jobs, composed from operators: log split, facts, window tables, report."""
