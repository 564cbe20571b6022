"""Thermolytics: meter-data analytics and anomaly scoring as Spark DataFrame operators.

Sub-packages:
  sources    readers, writers and keyed stores (Parquet / JSON / CSV)
  functions  column-expression helpers (dates, numeric guards)
  operators  DataFrame -> DataFrame transformations (cleaning, daily roll-up,
             windows, model fit/score, evaluation, alerts, validation)
  plans      end-to-end jobs composed from operators
  streaming  incremental variants on Structured Streaming
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Kernels travel to the executors with their code, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
