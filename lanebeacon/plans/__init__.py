"""Whole runs: daily loads into master tables, and views written from them."""
