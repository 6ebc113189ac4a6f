"""Batch analytics over shop data on Spark: raw JSON to clean tables to business tables."""
