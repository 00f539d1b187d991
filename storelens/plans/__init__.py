"""Statement-level analyses composed from the operators, and their registry."""
