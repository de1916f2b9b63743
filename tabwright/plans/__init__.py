"""Plans of the customer analytics engine."""
