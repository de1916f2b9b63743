"""Streaming of the customer analytics engine."""
