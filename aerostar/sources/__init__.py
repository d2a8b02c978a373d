"""Table sources: the derived star schema, ETL batches, extracts and file/JDBC readers."""
