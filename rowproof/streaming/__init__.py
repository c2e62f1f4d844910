"""Validation of files as they arrive."""
