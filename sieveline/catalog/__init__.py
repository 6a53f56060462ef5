"""Registered queries over the benchmark tables, and the SQL that must agree with them."""
