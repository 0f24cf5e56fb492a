"""Cairn: catalogue maintenance and corpus preparation on PySpark."""
