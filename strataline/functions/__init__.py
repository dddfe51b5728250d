"""Column expressions: text, casts, checks, ratios, bands, dates, labels, keys."""
