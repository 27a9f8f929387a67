"""Incremental loading of arriving files."""
