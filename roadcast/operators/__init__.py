"""Table operators: joins, dedup, lags, labels, splits, metrics."""
