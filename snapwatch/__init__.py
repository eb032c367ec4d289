"""Snapshot churn analytics on PySpark: extract, load, compare and report daily job-posting snapshots."""
