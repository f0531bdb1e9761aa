"""Channel and video statistics on Spark DataFrames.

Every operator is a function from DataFrame to DataFrame.  Nothing here opens a
session on import, and the run instant (``as_of``) is always an argument.
"""
