"""pricelens: Spark-native operators for reconciling and modelling prices from two sources.

Every public operator takes DataFrames and returns a lazy DataFrame; only one-row
metric gates, short dimension lists with a checked size, and fitted model parameters
ever reach the driver.
"""

__version__ = "0.1.0"
