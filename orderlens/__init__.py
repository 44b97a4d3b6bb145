"""Order-item analytics on PySpark: flatten, marts, refreshed tables and dashboard reports."""
