"""Spark-native medallion analytics: Bronze landing, Silver cleaning, Gold star, SQL on top.

Everything is a function from DataFrame to DataFrame (or Column to Column).
Nothing here holds a session or registers a UDF.
"""
