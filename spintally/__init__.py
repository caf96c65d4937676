"""Play-event analytics on Spark: windowed aggregates, rankings, history and reconciliation."""
