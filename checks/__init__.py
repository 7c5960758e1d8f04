"""Registered queries over the given tables, each with SQL that computes the same result."""
