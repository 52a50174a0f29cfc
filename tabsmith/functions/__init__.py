"""Column -> Column helpers. Everything here stays a built-in Spark expression."""
