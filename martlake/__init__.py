"""martlake: batch and streaming data-platform operators on Spark DataFrames."""

__version__ = "0.1.0"
