"""tidemart: retail marts, commerce batch jobs and market streams on Spark."""
