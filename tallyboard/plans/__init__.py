"""Whole reports: one week, many reports, every past week, a scheduled run."""
