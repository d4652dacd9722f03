"""Data-pipeline operators written as plain functions over Spark DataFrames."""
