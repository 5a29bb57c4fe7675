"""parcelbeam: property-assessment analytics as Spark DataFrame jobs.

Three recurring jobs -- a value-change check, unit review sheets and a
sale-ratio study -- built from Spark joins, aggregates and range-partitioned
ranks.  Every public function maps DataFrames to DataFrames; nothing is
collected to the driver.
"""

__all__ = ["functions", "operators", "sources", "plans", "session"]
