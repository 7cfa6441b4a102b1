"""Whole jobs: view refresh, and the registered queries with their SQL counterparts."""
