"""Readers and staged writers."""
