"""Column-level helpers (pure expressions unless noted)."""
