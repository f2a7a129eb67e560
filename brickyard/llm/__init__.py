"""Operators of a training-data pipeline, one module per operator.

Nothing outside this folder imports it; ``queries`` holds the registered
queries and the SQL that checks them.
"""
