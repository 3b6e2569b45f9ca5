"""Operators for building language-model training data at corpus scale.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface, the ``opN_<name>`` query that applies it to a
whole input table, and the query's SQL where SQL can express it.
"""
