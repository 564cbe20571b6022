"""Operators of a training-data pipeline, as Spark DataFrame functions.

Nothing else in the package imports this one. Registered queries are in ``queries``.
"""
