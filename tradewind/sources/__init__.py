"""Reading and writing the lake: CSV landing, Parquet layers, scratch folder, dataset registry."""
