"""Test queries: domain relations derived from the driver tables, and their SQL checks."""
