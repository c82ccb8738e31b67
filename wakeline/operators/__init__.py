"""DataFrame-to-DataFrame operators: cleaning, joins, sessions, latest rows, merges, statistics."""
