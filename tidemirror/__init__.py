"""Keep analytical tables in step with an operational source, on Spark."""
