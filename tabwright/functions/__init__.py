"""Functions of the customer analytics engine."""
