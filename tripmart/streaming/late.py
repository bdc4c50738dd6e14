"""Late rows counted and kept.

A windowed aggregate drops rows that come behind the watermark; here they are
told apart first.  Each micro-batch is split at the watermark its predecessors
left (their greatest event time less the delay): rows in time and late ones go
to the two partitions of one table in one write, and the counts come from
metrics observed by that same write.  The account of a batch (rows in time,
late rows, greatest event time) is appended to a table of its own, from which
the next batch, after a restart too, takes its watermark.  Both appends are
named after the batch, so a replayed batch replaces what it wrote.

A row without an event time is in time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripmart.operators.table_store import TableStore
from tripmart.streaming.jobs import batch_name

ACCOUNT = "query string, batch_id long, in_time long, late long, newest long"


def _delay_us(delay: str) -> F.Column:
    return F.expr(f"CAST(unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {delay}) AS BIGINT)")


def watermark_before(account: TableStore, query: str, batch_id: int) -> int | None:
    """Greatest event time (microseconds) of the query's earlier batches."""
    if not account.exists():
        return None
    earlier = account.read().where((F.col("query") == query) & (F.col("batch_id") < batch_id))
    return earlier.agg(F.max("newest")).first()[0]


def split_sink(rows: TableStore, account: TableStore, ts: str, delay: str, name: str = "split") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler; ``rows`` must be partitioned by ``late``.

    ``delay`` as in ``withWatermark`` ('5 seconds').  As there, a watermark is
    in whole milliseconds and a row is late when it is older.
    """
    if rows.partition_by != ["late"]:
        raise ValueError("the table of rows must be partitioned by late")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch_of = batch_name(name, batch, batch_id)
        query = batch_of.rsplit("-", 1)[0]
        newest = watermark_before(account, query, batch_id)
        us = F.unix_micros(F.col(ts).cast("timestamp"))
        mark = F.floor((F.lit(newest) - _delay_us(delay)) / 1000) * 1000
        late = F.lit(False) if newest is None else F.coalesce(us < mark, F.lit(False))
        seen = Observation()
        metrics = [F.count_if(~F.col("late")).alias("in_time"), F.count_if("late").alias("late"), F.max(us).alias("newest")]
        rows.append(batch.withColumn("late", late), batch=batch_of, observe=(seen, metrics))
        got = seen.get
        newest = got["newest"] if newest is None or (got["newest"] or newest) > newest else newest
        one = batch.sparkSession.createDataFrame([(query, batch_id, got["in_time"], got["late"], newest)], ACCOUNT)
        account.append(one, batch=batch_of)
    handle.checkpoint = f"{rows.path}/_checkpoints/{name}"
    return handle


def in_time(rows: TableStore) -> DataFrame:
    return rows.read().where(~F.col("late")).drop("late")


def late(rows: TableStore) -> DataFrame:
    """The side table."""
    return rows.read().where("late").drop("late")
