"""Compositions: the query registry, SQL views and the end-to-end build."""
