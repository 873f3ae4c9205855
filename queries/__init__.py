"""Registered queries: each runs an operator of the library on the test tables, with its oracle SQL."""
