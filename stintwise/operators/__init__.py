"""Operators: career relations, nested-data normalisation, schema discovery, graph."""
