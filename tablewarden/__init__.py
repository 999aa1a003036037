"""Table care on Spark: cleaning and loading, backup and restore, monitoring."""
