"""tradewind: supply-chain analytics expressed as Spark plans.

Every operator is a function from DataFrames to a DataFrame.  Nothing is
collected, no Python code runs per row, and each layer can be written to and
re-read from any Spark-visible path.
"""

__version__ = "0.1.0"
