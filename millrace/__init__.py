"""Millrace: batch and streaming analytics operators written as plain PySpark DataFrame functions."""
