"""Analysis of operational logs and timed records with Spark."""
