"""litengine: literature mining and curated-assertion reconciliation on Spark DataFrames."""

__version__ = "0.1.0"
