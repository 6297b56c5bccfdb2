"""Operators for large-scale training data, their queries and SQL.

Nothing outside this folder imports it; `__spark_entry__.py` adds its queries
when it is there.
"""
