"""Trajectory analytics on PySpark DataFrames."""
