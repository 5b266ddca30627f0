"""Column expressions: text, header keys, parsers and similarity."""
