"""Order-feature analytics on Spark: sources, validation, features, evaluation."""
