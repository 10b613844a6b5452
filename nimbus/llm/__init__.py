"""Operators of a training-data pipeline, as Spark jobs.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; ``queries.py`` registers one thin query per
operator and the pipeline.
"""
