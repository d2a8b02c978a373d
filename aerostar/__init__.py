"""aerostar: an airline star-schema warehouse (ETL, data quality, KPI reports
and marts) written as PySpark DataFrame jobs."""
