"""DataFrame operators: ordered rows, joins, aggregates, gap filling."""
