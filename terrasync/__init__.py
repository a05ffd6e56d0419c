"""Incremental geospatial synchronisation and corpus preparation on PySpark."""
