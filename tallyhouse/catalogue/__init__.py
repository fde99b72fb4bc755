"""Registered queries: the operators run over whole tables, with the SQL they are checked against."""
