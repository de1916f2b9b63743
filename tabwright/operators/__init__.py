"""Operators of the customer analytics engine."""
