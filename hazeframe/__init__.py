"""Air-quality, weather and traffic analytics as PySpark DataFrame operators."""
