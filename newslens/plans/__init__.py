"""Query plans: the nine queries, the reference calls, window ingest, registered keys and oracle."""
