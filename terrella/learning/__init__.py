"""Learning operators: splits, Spark ML estimators and gradient steps."""
