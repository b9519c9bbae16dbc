"""Queries over the test tables: views that stand in for the domain tables, the queries and their SQL."""
