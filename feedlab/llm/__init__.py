"""Operators for preparing training text: one module per operator.

Nothing else in the library imports this subpackage.  Each operator takes and
returns DataFrames; the thin ``op<N>_<name>`` queries are in ``queries.py``.
"""
