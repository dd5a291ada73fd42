"""Column helpers that the operators share."""
