"""Inputs: schemas, fixed code tables, readers and test-data adapters."""
