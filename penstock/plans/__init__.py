"""Registered queries and the SQL to check them against."""
