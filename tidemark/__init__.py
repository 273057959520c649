"""Table-level load, change-tracking and history operators for PySpark.

Every operator is a function from DataFrames to a DataFrame; nothing is
written or collected unless the function's docstring says so.
"""
