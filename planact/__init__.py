"""Plan-versus-actual analytics as Spark DataFrame transformations.

Layout
------
functions   column expressions (rounding, dates, ids, cleaning, comparison, display)
operators   DataFrame -> DataFrame building blocks (actuals, plan, telemetry, change, upsert ...)
sources     readers for landed sheet exports, movement folders, telemetry folders and tables
sinks       Parquet writers (append, insert-if-absent, upsert, report folders)
plans       the user-facing reports and loads composed from the operators
streaming   the same feeds as Structured Streaming jobs
catalog     named queries over the test tables, each with its SQL counterpart
"""

__version__ = "0.1.0"
