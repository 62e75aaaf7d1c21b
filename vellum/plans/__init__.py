"""Queries over the shared test tables and the SQL that they are checked against."""
