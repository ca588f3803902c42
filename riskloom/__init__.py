"""Tabular risk analytics as Spark DataFrame functions and ``pyspark.ml`` stages."""
