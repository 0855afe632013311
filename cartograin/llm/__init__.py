"""Operators for building training corpora.

One module per operator; ``catalog`` holds the registered queries and ``oracle``
their SQL. Nothing outside this subpackage imports it.
"""
