"""Operators for large-scale training-data pipelines (one module per operator).

Nothing outside this subpackage imports it; ``queries.py`` registers one query
per operator and ``sql.py`` holds the SQL of those that SQL can express.
"""
