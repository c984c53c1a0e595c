"""Column expressions and small schema helpers (no data passes through the driver)."""
