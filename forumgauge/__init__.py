"""Discussion analytics as composable Spark DataFrame functions."""
