"""Wide telemetry on Spark: sources, cleaning, profiling, reconciliation and browse queries."""
