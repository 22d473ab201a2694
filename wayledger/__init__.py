"""Wayledger: Spark-native processing of vehicle-tracker logs and scanned text."""
