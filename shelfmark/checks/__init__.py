"""Adapters from the benchmark tables to listings and sales, with queries and their SQL twins."""
