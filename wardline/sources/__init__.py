"""Reading, writing and resuming: Parquet tables, CSV reports and sampler draws."""
