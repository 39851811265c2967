"""Sources and sinks: panels derived from the driver's event table, CSV/parquet files."""
