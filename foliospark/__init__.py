"""Document analytics on Spark."""
