"""The operators run on the given tables, each with an independent SQL form."""
