"""Whole jobs, and the registered queries with the SQL they are checked by."""
