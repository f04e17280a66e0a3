"""Scans: landed files and tables to DataFrames."""
