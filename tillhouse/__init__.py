"""Retail sales lakehouse on Spark: landed documents -> typed lines -> daily facts -> marts -> metrics."""
