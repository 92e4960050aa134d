"""Registered queries: each operator run over the given tables, next to the SQL it must agree with."""
