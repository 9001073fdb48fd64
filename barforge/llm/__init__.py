"""Operators for preparing training text: one module per operator.

Each module holds the operator with its general interface; ``catalog.py``
holds the registered queries ``opN_<name>``.  Nothing outside this package
imports it.
"""
