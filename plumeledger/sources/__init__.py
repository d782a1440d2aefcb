"""CSV file sets in, keyed Parquet tables in and out."""
