"""Card-fraud analytics as PySpark ``DataFrame -> DataFrame`` operators."""
