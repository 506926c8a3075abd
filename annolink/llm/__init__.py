"""Operators for training-data pipelines (language ID, dedup, PII, packing, ...).

Nothing outside this subpackage imports it; ``queries.py`` registers one query
per operator and ``oracle.py`` the SQL where SQL can express the result.
"""
