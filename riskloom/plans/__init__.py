"""Bindings of the operators to concrete tables, with a SQL oracle beside each."""
