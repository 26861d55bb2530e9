"""Queries over the test tables, and the same queries as SQL for a second engine."""
