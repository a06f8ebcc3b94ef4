"""Sales and weather analytics on Spark: functions from DataFrame to DataFrame."""
