"""Review analytics on Spark: DataFrame-to-DataFrame operators for large review collections."""
