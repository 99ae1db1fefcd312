"""Pipelines over postings and the registry of queries."""
