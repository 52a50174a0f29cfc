"""Tree models and their tuning, on Spark ML."""
