"""The registered queries: operators over the given tables, and their SQL checks."""
