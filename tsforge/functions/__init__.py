"""Column expressions: times, globs, identities."""
