"""Reading the given tables, assembling the demand fact, reading and writing it."""
