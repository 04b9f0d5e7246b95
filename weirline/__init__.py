"""weirline: log and measurement analytics written as Spark DataFrame jobs."""
