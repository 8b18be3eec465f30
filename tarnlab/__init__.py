"""tarnlab: a monitoring-data engine on Apache Spark."""
