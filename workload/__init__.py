"""Stand-in inputs derived from the test tables, registered queries and their SQL oracles."""
