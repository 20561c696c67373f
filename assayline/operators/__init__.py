"""Quality checks, key lookups and metrics over DataFrames."""
