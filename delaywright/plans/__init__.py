"""Registered queries: each one a library call on the given tables, with its checking SQL."""

from delaywright.plans.registry import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries"]
