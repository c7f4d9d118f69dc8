"""Queries over the test tables, one per operator, and the SQL that must give the same rows."""
