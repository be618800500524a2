"""promptframe: Spark DataFrame operators for batch labelling jobs.

Every public operator is a function from DataFrames to DataFrames; nothing is
collected unless its size is bounded by a setting or by the label set.
"""
