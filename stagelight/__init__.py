"""Spark-first analytics over collected event listings, with a training-data subpackage."""
