"""Column expressions: validity rules, flag texts, classifications."""
