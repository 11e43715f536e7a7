"""Plans: the result tables, the analyst queries, the daily run and the
registry of named queries."""
