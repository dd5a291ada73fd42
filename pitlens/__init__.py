"""Point-in-time equity research on Spark: sources, operators, plans and streams as plain DataFrame functions."""
