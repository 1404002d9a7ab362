"""Complete plans: corpora from tables, the operators applied to them, and their SQL oracles."""
