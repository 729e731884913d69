"""Scans and sinks: YAML document folders, CSV tables, test-table bindings."""
