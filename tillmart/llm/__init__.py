"""Operators of a training-data pipeline over the ``documents`` table.

Nothing outside this subpackage imports it (``__spark_entry__`` registers its
queries only where it can be imported).
"""
