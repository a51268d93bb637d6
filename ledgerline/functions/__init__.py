"""Column expressions: casts, derived values and row digests."""
