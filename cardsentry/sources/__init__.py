"""Readers for the daily drops (delimited text) and the master tables."""
