"""Independent SQL twins of the registered queries, for a second engine to run."""
