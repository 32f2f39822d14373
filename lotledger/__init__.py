"""Spark-native analytics over property-transfer tax tables.

Every operator takes and returns DataFrames (or Columns); nothing here holds
a session or a path globally.
"""
