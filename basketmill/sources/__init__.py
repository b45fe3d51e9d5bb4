"""Readers, writers, table loading and the retail roles of the given tables."""
