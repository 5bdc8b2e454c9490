"""Market-data analytics on Spark: ticks to bars, features, labels, trades and drift reports."""
