"""Time and exact-number column expressions."""
