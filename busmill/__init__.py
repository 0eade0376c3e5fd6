"""Transit telemetry on Spark: positions, trips, facts, quality rules and telemetry windows as DataFrame operators."""
