"""Operators for preparing training data: one module per operator, one registry.

Nothing outside this folder imports it; ``__spark_entry__`` adds its
queries when the folder is there.
"""
