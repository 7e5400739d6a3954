"""DataFrame operators: joins, aggregates, exact ranks, sampling, folds, metrics."""
