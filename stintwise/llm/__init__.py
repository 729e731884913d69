"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Queries are registered
in ``stintwise.llm.queries``; ``corpus_pipeline.py`` at the repository top
chains four of the operators.
"""
