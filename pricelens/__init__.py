"""pricelens: Spark-native profiling, encoding and price modelling for listing tables.

Every public function takes and returns Spark DataFrames (or Spark ML stages), so the
work runs on the cluster and only small, bounded summaries ever reach the driver.
"""

__version__ = "0.1.0"
