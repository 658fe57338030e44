"""Sources and sinks: CSV splits, Parquet checkpoints, fixtures."""
