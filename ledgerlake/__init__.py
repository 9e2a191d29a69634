"""Trading-account lakehouse on Spark: raw JSON events to bronze, silver and gold tables."""
