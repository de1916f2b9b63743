"""Registered queries of the customer analytics operators, each beside the SQL that checks it."""
