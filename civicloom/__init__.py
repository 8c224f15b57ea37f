"""civicloom: community-indicator warehouse operators as lazy Spark DataFrames."""

__version__ = "0.1.0"
