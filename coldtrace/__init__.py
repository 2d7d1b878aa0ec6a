"""Cold-chain telemetry analytics expressed as PySpark DataFrame and streaming jobs."""
