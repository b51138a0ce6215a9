"""Registered queries by group; each module has QUERIES and SQL."""
