"""DataFrame → DataFrame operators: ranks, prep, joins, reshape, sampling,
series, charts, text, topics, classify (plus checkpoint/layout helpers)."""
