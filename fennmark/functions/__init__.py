"""Functions of the library."""
