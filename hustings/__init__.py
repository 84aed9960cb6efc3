"""Contest-outcome analytics on Spark: grids in, winners, models and rankings out."""
