"""Spark-native analytics for perishable-goods operations.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects and is
built from built-in Spark SQL expressions, so Catalyst can push filters, prune
columns and pick join strategies.  Sub-packages:

* ``functions``  column-level rules (null semantics, coercions, scalar formulas)
* ``sources``    typed scans, domain views, forecast store, incremental reads
* ``operators``  curation, forecasting, dashboard reports, data-quality checks
* ``plans``      end-to-end runs composed from the operators
* ``streaming``  Structured Streaming incremental loads
"""

from perishables.settings import ForecastSettings, ReportFilters

__all__ = ["ForecastSettings", "ReportFilters"]
