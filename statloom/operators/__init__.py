"""DataFrame operators: measures, joins, star maintenance, ranks, reshaping, LOWESS."""
