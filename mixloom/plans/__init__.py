"""Registered queries: the operators applied to the provided tables, with their SQL."""
