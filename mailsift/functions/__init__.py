"""Column expressions: text, paths, sparse features."""
