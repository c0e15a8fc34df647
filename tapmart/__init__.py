"""tapmart: smart-card trip analytics as lazy, composable Spark DataFrame operators."""

__version__ = "0.1.0"
