"""emberlog: device and network log analytics as plain Spark DataFrame jobs."""
