"""DataFrame -> DataFrame operators, each one partitioned by (series key, time chunk)."""
