"""rainroute: bus trips x hourly rain, batch and streaming analytics on Spark.

Every public function takes and returns DataFrames; only ``sources`` and the
jobs in ``plans.jobs`` touch storage.
"""

__version__ = "0.1.0"
