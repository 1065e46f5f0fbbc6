"""Column functions and rule packs."""
