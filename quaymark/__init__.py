"""quaymark: market-data processing operators expressed on Spark DataFrames.

Sub-packages: ``sources`` (readers and sinks), ``functions`` (column
expressions), ``operators`` (DataFrame to DataFrame), ``plans`` (registered
queries and their SQL), ``streaming`` (the incremental forms).
"""
