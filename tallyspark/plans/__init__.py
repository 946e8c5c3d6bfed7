"""The operators bound to the tables, each with equivalent SQL where it has any."""
