"""Registered queries: the operators bound to tables, with the SQL they are checked against."""
