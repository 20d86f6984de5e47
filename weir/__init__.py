"""Contract-driven order pipelines on Spark, the same for batch and streams."""
