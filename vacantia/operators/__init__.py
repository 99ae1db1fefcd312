"""DataFrame operators that take column names, rules and thresholds."""
