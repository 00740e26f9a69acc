"""Spark operators for migrating, checking and serving a table of patient records."""
