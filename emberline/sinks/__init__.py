"""Writers: DataFrames to snapshot tables, split files and reports."""
