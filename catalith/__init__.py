"""catalith: catalogue, change-tracking and data-contract jobs on Spark.

Every operator takes DataFrames and returns DataFrames. Checks return rows of
one shared issue shape (see :mod:`catalith.issues`).
"""
