"""Readers: CSV files, file listings, tables and run registration."""
