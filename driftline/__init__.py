"""driftline: snapshots, change logs and declared types as Spark DataFrames."""
