"""Reusable data operators: ETL steps, upsert, SCD2, surrogate keys, data quality, audit."""
