"""PySpark operators for advertising logs, experiments and keyed training tables."""
