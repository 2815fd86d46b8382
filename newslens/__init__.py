"""newslens: news-event feed ingest and analytics on Spark DataFrames.

Subpackages: ``functions`` (column expressions for the feed's mini-languages),
``sources`` (feed lines, archives, manifests, serving tables, test fixtures),
``operators`` (join/clean pipelines, keyed dedup and merge, per-period top-k),
``plans`` (the analytical queries, window ingest, registered query catalog),
``streaming`` (the ingest as a Structured Streaming job).
"""
