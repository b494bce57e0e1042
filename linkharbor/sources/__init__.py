"""Readers: web-graph text files, record CSV files, company lists."""
