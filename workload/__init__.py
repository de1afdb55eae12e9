"""Registered queries: each module binds the library to given tables and states the same query in SQL."""
