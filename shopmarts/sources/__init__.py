"""Sources and sinks: file contracts, raw CSV scan and conform, staged Parquet publish."""
