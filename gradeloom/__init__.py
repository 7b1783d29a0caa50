"""Gradeloom: fine-tuning data preparation and evaluation analytics on Spark.

Every operator takes and returns DataFrames or Columns and stays lazy unless its
docstring says otherwise.
"""
