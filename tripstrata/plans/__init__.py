"""Runs that chain the operators, and the registered queries with their oracle SQL."""
