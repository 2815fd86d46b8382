"""Column expressions for the feed's delimited mini-languages (no Python UDFs)."""
