"""Incremental streams over landed files."""
