"""signalyard: market-signal analytics on Spark.

Every public function maps DataFrames to DataFrames (or runs a Spark job
that writes one); nothing is collected to the driver except scalars and
"""

__version__ = "0.1.0"
