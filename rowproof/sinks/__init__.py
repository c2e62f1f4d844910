"""Writers: CSV files, partitioned files, tables and fixed target layouts."""
