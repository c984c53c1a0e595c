"""Sales-data ETL, data quality and row-level security as Spark DataFrame plans."""
