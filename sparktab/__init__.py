"""sparktab: a Spark-native tabular regression pipeline.

Scan, profile, split, encode, fit, score and measure tables with DataFrames,
Spark ML and Structured Streaming; only fitted statistics reach the driver.
"""

__version__ = "0.1.0"
