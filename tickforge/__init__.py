"""tickforge: market-tick analytics as composable Spark DataFrame operators."""
