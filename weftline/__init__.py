"""weftline: record linkage and training-data preparation, written for Spark's DataFrame engine."""
