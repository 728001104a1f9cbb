"""Table builders and queries composed from the operators."""
