"""DataFrame -> DataFrame operators: rollups, search, relevance, joins, request path, ML."""
