"""Reading and writing tables, run records and fitted models."""
