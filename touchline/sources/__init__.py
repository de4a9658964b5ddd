"""Sources and sinks: landing files, bronze CSV scans, layer Parquet I/O."""
