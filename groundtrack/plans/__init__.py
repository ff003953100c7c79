"""Registered queries (``queries``, ``streams``), their SQL oracle
(``oracle``) and the operator inventory (``inventory``).
"""
