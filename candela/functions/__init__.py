"""Column builders: exact rolling statistics, indicator formulas, rounding."""
