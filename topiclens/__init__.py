"""topiclens: topic analytics for article collections and click data, on Spark.

Operators take DataFrames and give DataFrames; column functions take and give
Columns. Nothing here runs an action except fitting a model and writing a table.
"""
