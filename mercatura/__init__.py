"""Retail lakehouse and near-duplicate resolution jobs as PySpark DataFrame operators."""
