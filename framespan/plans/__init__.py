"""Registered queries: each operator applied to the test tables, with the SQL that gives the same rows."""
