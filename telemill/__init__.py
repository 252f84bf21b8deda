"""Fleet telemetry tables built and analysed as Spark DataFrame plans."""
