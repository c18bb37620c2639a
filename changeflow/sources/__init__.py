"""Reading change feeds, commit ledgers and the tables derived from the test data."""
