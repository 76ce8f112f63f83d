"""Column expressions: text cleaning, similarity, JSON access, branded-search rules."""
