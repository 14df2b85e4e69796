"""Column-level building blocks; all of them stay inside Catalyst expressions."""
