"""DataFrame operators: aggregates, windows, joins, samples, scaling, graphs."""
