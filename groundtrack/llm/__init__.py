"""Operators for preparing training text at scale.

One module per operator, each with a general ``DataFrame -> DataFrame``
interface; ``queries`` binds them to the test tables. Nothing outside this
subpackage imports it.
"""
