"""Queries over the given star-schema tables, and a SQL check for each."""
