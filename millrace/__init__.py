"""Layered commerce lakehouse on PySpark: ingest, clean, merge, warehouse, marts, scoring."""
