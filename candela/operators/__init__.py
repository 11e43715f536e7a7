"""DataFrame operators: recurrences, indicators, signals, ranking, merges."""
