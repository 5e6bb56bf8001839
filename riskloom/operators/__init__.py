"""DataFrame operators: profiling, cleaning, features, labels, metrics and scoring."""
