"""Table and stream operators on the Spark DataFrame API."""
