"""Analytics over industrial machine telemetry, written as Spark DataFrame jobs."""
