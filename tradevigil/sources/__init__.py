"""Feeds, tables and the views over the sample tables."""
