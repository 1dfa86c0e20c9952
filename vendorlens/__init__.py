"""vendorlens - supplier-risk analytics on Spark.

Every operator is a function from DataFrames to a DataFrame built on Spark
SQL expressions; see README.md for the map of operators to modules."""

__version__ = "0.1.0"
