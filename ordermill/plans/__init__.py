"""Compositions: stores, pipeline runs, and the query registry."""
