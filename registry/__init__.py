"""Named queries and their SQL checks."""
