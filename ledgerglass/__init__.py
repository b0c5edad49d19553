"""Card-transaction risk analytics as composable PySpark operators."""
