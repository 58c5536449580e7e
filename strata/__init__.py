"""strata: a Spark-native medallion lake.

Landing batches (CSV, JSON) move through bronze and silver tables to a gold
revenue mart, each step guarded by data-quality gates evaluated as Spark
aggregates. Failing batches are quarantined and never published.
"""

__version__ = "0.1.0"
