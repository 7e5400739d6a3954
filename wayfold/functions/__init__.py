"""Column expressions: row-local, no shuffle, usable on batch and streaming frames alike."""
