"""Write planning (pure) and Parquet writers."""
