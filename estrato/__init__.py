"""estrato: layered (bronze, silver, gold) data work on Spark DataFrames.

Every operator is a function from DataFrames to DataFrames.  Nothing here
collects a table, and no operator's result depends on how its input happens to
be partitioned.
"""
