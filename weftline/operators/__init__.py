"""DataFrame operators of record linkage: candidates, features, scoring, thresholds, metrics, checks."""
