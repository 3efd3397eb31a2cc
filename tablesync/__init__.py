"""Keep lake and warehouse tables in step: incremental reads, keyed merges, checks and publishing on Spark."""
