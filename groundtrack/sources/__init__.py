"""Inputs: ``tables`` (parquet / JDBC readers) and ``fixtures`` (position
and request views derived from the ``events`` table).
"""
