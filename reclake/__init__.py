"""reclake: recommendation data work as PySpark DataFrame operators."""
