"""Operator chains and the query registry."""
