"""Weather and sensor observation analytics as plain Spark DataFrame functions."""
