"""sigscore: hourly scoring of operational signals on Spark.

Column functions (``sigscore.functions``), DataFrame operators (``sigscore.operators``),
sources (``sigscore.sources``), sinks (``sigscore.sinks``), the hourly job
(``sigscore.plans``) and its incremental streaming form (``sigscore.streaming``).
"""

__version__ = "0.1.0"
