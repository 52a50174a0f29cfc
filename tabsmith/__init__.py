"""Feature engineering, tree-model training and evaluation for one wide table, on Spark."""
