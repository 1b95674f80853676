"""Pure column expressions."""
