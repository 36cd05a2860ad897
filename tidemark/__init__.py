"""Tidemark: market-data audit, replay analytics and text-corpus operators on PySpark."""
