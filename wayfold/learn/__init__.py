"""Spark ML work: cross-validation, rankers, stacking, decomposition, clustering."""
