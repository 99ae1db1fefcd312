"""Readers and writers for delimited, JSON and parquet postings."""
