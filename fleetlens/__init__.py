"""A PySpark engine for product registries, their change over time and market comparison."""
