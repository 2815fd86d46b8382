"""DataFrame operators: join and cleaning pipelines, keyed dedup and merge, per-period top-k."""
