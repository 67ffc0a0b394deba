"""Dictionary matching on Spark."""
