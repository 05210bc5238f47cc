"""Operators for large text collections; see ``queries`` for the registered queries."""
