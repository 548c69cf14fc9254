"""Table-to-table operators: keyed update, lookups, ranking, quality, reconciliation."""
