"""kardex: retail sales and inventory analytics as Spark DataFrame plans.

Layers:
  sources/    readers for raw files and the bindings of the test tables to the retail roles
  functions/  column-expression helpers (rounding, dates, safe division, lookups)
  operators/  DataFrame -> DataFrame operators (conform, identity, as-of, islands, periods,
              turnover, margin, KPIs, data quality)
  plans/      the star-schema model, the analytics run and the batch job
  sinks/      table writers
  streaming/  (nothing: the workload is batch only)
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
