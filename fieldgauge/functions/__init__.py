"""Column expressions: time, bands, quality rules, alert rules."""
