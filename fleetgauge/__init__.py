"""Fleet telemetry analytics as plain DataFrame-to-DataFrame functions on Spark."""
