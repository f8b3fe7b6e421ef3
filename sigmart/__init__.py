"""Safety-signal analytics as PySpark DataFrame operators."""
