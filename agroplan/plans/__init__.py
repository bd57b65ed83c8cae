"""Registered queries and composed pipelines."""
