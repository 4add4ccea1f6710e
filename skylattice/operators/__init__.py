"""Pure functions from DataFrames and explicit bounds to a DataFrame.

Operators start no session, read no clock and trigger no job.
"""
