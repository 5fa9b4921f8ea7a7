"""Whole jobs: the four phases, and the registered queries with their check SQL."""
