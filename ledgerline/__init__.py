"""ledgerline: restaurant sales analytics as composable Spark DataFrame operators.

Layers:
  sources/    readers, writers, catalog registration, testdata adapters
  functions/  Column -> Column helpers (cleaning, money, period keys)
  operators/  DataFrame -> DataFrame building blocks (silver, revenue, ranking, marts)
  plans/      composite marts, dashboard views, the layer pipeline, quality checks
  streaming/  incremental (micro-batch) form of the silver cleaning
"""

from ledgerline.config import Thresholds

__all__ = ["Thresholds"]
