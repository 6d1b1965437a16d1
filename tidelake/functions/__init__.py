"""Types and expressions."""
