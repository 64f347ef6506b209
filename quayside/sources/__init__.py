"""Scans: files by layout, delimiter or column format, listings, and tables over JDBC."""
