"""Operators for preparing large text corpora.

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` holds
the registered ``opN_<name>`` queries and ``queries.SQL`` their DuckDB oracles.
"""
