"""Feature tables composed from the operators."""
