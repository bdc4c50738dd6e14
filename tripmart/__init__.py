"""tripmart: layered batch + streaming data marts on Spark.

Every operator is ordinary DataFrame / Spark SQL / Structured Streaming
code.  Sub-packages:

* ``sources``    typed readers (CSV, Parquet, JSON, paged, event streams, ledger)
* ``functions``  Column -> Column helpers (keys, labels, money, time)
* ``operators``  DataFrame -> DataFrame building blocks (conform, joins,
                 dedupe, union, windows, materializations, quality checks)
* ``plans``      the star-schema marts and the registered queries
* ``streaming``  event-time streams, windows and keyed idempotent sinks
"""

__version__ = "0.1.0"
