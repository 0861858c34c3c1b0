"""ledgerlens — ticket-compliance analytics as Spark DataFrame operators.

Sub-packages:
  sources    reading ticket tables (CSV, parquet) and the driver-table view
  functions  column expressions (text, time, numbers)
  operators  DataFrame -> DataFrame steps (filters, profiling, cleaning,
             vocabularies, encoding, segments)
  plans      joins, models, metrics, the routed scoring plan, query catalog
  streaming  the stateless steps applied to a stream of tickets
"""

__version__ = "0.1.0"
