"""DataFrame operators: columns, joins, aggregates, metrics, windows, ordering."""
