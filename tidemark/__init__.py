"""Warehouse-style analytic operators for PySpark: plain functions from DataFrame to DataFrame."""
