"""Compiled pipelines and the query registry."""
