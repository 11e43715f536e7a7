"""Operators for training-data corpora on Spark. Nothing outside this
subpackage imports it."""
