"""Plans: domain inputs derived from the test tables, and one query per operator with its SQL."""
