"""Operators for preparing training text: one module per operator, queries and their SQL in ``queries`` and ``oracles``."""
