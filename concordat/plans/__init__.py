"""Queries over named tables, with the SQL that checks each."""
