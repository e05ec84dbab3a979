"""Sources and sinks: claim CSV files (S1-S7) and the driver's Parquet tables."""
