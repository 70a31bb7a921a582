"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; the queries of the check tool are in ``queries``.
"""
