"""Whole loads, re-ingests and reports, put together from the other packages."""
