"""The registered queries: every operator, run over whole tables of the test data."""
