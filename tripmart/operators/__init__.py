"""Relational operators of the pipeline: staging, star schema, marts,
incremental writes and data-quality checks."""
