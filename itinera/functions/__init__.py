"""Column-level rules: flight numbers, dates, text, airport chains, times."""
