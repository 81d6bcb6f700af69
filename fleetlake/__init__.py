"""fleetlake: endpoint-security telemetry operators on Spark DataFrames."""
