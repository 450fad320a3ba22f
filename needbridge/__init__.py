"""needbridge — Spark-native table operators for social-care programme monitoring.

Every public operator takes DataFrames and returns a DataFrame; columns, date
windows and thresholds are parameters.  Nothing is collected to the driver
except size-bounded metadata (hot-key lists, partition summaries).
"""

__version__ = "0.1.0"
