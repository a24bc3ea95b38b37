"""Scans: files, catalog tables, JDBC catalogs, CSV dimensions, entity documents."""
