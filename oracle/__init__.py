"""Hotspots derived from the test tables, and the SQL that checks the jobs on them."""
