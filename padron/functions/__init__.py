"""Column builders: text helpers, normalisers, documents, derived columns and rules."""
