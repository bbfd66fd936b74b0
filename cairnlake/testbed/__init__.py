"""Bronze inputs derived from the supplied test tables, for Spark and, as SQL, for the oracle."""
