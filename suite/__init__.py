"""Registered queries over the given star-schema tables, and the SQL they are checked against."""
