"""stationlens: price-observation analytics as Spark DataFrame operators.

Layers:
  functions/  pure Column builders (no actions, no UDFs)
  operators/  DataFrame -> DataFrame operators (series, ranks, reports, history, quality, anomalies)
  sources/    feed/raw/mart readers and writers
  plans/      the fuel-domain build assembled from operators, and the driver query catalogue
  streaming/  incremental (micro-batch) refresh of the versioned history
"""

from stationlens.session import configure, get_spark, checkpoint_dir  # noqa: F401

__all__ = ["configure", "get_spark", "checkpoint_dir"]
