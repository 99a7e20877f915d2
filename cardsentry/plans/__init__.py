"""Whole jobs: fixture views, SQL oracle twins, the daily cycle, the catalog."""
