"""Change logs to analytics tables on Spark."""
