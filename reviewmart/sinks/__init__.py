"""Writers: Parquet and CSV folders, catalog and connector tables, views."""
