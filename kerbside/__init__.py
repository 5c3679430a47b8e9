"""Trip-record analytics as lazy Spark DataFrame functions."""
