"""Register and filing analytics as composable PySpark DataFrame operators."""
