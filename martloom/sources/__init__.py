"""Reading landing files and contracts, and reading and writing tables."""
