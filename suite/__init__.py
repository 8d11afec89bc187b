"""Registered queries and their oracle SQL, one module per group of operators."""
