"""Sources of the customer analytics engine."""
