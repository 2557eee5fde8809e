"""linkloom: link-telemetry analytics as DataFrame-to-DataFrame operators on Spark."""
