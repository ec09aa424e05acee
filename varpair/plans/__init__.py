"""Composed jobs, stand-in inputs, registered queries and their oracle SQL."""
