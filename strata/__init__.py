"""strata: a medallion data-quality pipeline on PySpark.

Layers: raw contract checks, bronze lineage, the silver/quarantine split with
reasons and flags, reconciled versioned publishes, typed staging and the
daily, monthly and data-quality marts, their checks and dashboard queries.

Subpackages: ``functions`` (column expressions and fixed contract names),
``operators`` (DataFrame -> DataFrame operators), ``sources`` (scans, sinks,
audit, landing and inspection), ``plans`` (fixture, jobs, registry, oracle
SQL) and ``streaming`` (the split as a Structured Streaming job).
"""

__version__ = "0.1.0"
