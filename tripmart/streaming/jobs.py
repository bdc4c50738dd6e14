"""Event-time streams: sources, watermarks, windows and keyed idempotent sinks.

The same function takes a Kafka topic on a cluster and a file directory in
tests (the Kafka connector jar is optional).  Aggregations run in Structured
Streaming state stores; tumbling windows emit in *update* mode into an
upsert sink, sessions in *append* mode (bounded state) - ``complete`` is for
tests only.  Checkpoints go under the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripmart.functions.columns import JSON_TS_OPTIONS, from_json_text, naive_to_instant, to_json_text
from tripmart.operators.table_store import TableStore
from tripmart.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# ------------------------------------------------------------------ sources

def read_events(spark: SparkSession, schema: T.StructType, *, kafka_servers: str | None = None,
                topic: str | None = None, path: str | None = None, fmt: str = "json",
                starting: str = "earliest", max_offsets: int | None = None, max_files: int | None = None) -> DataFrame:
    """Typed event stream.

    Kafka: the message ``value`` is JSON parsed with ``schema`` (declared, no
    inference); ``starting`` is ``earliest`` or ``latest``; Kafka metadata
    columns (topic, partition, offset, timestamp) are kept.  Files: a
    directory (or glob) of ``fmt`` files with the same schema.
    ``max_offsets`` (Kafka rows) or ``max_files`` bounds a micro-batch; the
    rest is read by the next ones.
    """
    if kafka_servers:
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
             .option("subscribe", topic).option("startingOffsets", starting))
        if max_offsets:
            r = r.option("maxOffsetsPerTrigger", max_offsets)
        raw = r.load()
        return raw.select("topic", "partition", "offset", F.col("timestamp").alias("kafka_ts"),
                          from_json_text(F.col("value").cast("string"), schema).alias("e")).select(
            "topic", "partition", "offset", "kafka_ts", "e.*")
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if fmt == "json":
        r = r.options(**JSON_TS_OPTIONS)
    return r.format(fmt).load(path)


def read_topic_batch(spark: SparkSession, kafka_servers: str, topic: str) -> DataFrame:
    """Bounded read of a whole topic (earliest -> latest), with key/value and
    partition/offset columns."""
    return (spark.read.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
            .option("subscribe", topic).option("startingOffsets", "earliest")
            .option("endingOffsets", "latest").load()
            .select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset"))


def publish_json(df: DataFrame, cols: Sequence[str], kafka_servers: str | None = None, topic: str | None = None,
                 path: str | None = None, key: str | None = None) -> None:
    """Publish rows as JSON messages (Kafka on a cluster, JSON text files otherwise)."""
    msg = df.select(*([F.col(key).cast("string").alias("key")] if key else []),
                    to_json_text(cols).alias("value"))
    if kafka_servers:
        msg.write.format("kafka").option("kafka.bootstrap.servers", kafka_servers).option("topic", topic).save()
    else:
        msg.select("value").write.mode("append").text(path)


# ---------------------------------------------------------------- event time

def with_event_time(df: DataFrame, ts: str = "ts", delay: str = "5 seconds", *,
                    epoch_millis: str | None = None, text: str | None = None,
                    text_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Event-time column + watermark.  The source may be epoch milliseconds,
    text in ``text_format`` (a UTC wall clock), or a timestamp; watermarks
    need TIMESTAMP, so a TIMESTAMP_NTZ column becomes the instant at its UTC
    wall clock (independent of the session time zone)."""
    if epoch_millis:
        df = df.withColumn(ts, F.timestamp_millis(F.col(epoch_millis)))
    elif text:
        df = df.withColumn(ts, naive_to_instant(F.to_timestamp_ntz(F.col(text), F.lit(text_format))))
    elif isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn(ts, naive_to_instant(ts))
    return df.withWatermark(ts, delay)


# ---------------------------------------------------------------- operators

def tumbling_counts(df: DataFrame, ts: str, size: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Windowed aggregate over the full window (start and end are both
    group keys, so an upsert on (window_start, keys) sees one row per window)."""
    g = df.groupBy(F.window(F.col(ts), size).alias("w"), *keys).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, *[c for c in g.columns if c not in ("w", *keys)])


def session_counts(df: DataFrame, ts: str, gap: str, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Session windows per key.  Sessions over all events have no key to
    spread by: see :mod:`tripmart.streaming.global_sessions`."""
    if not keys:
        raise ValueError("session windows need a key; use tripmart.streaming.global_sessions for all events")
    g = df.groupBy(*keys, F.session_window(F.col(ts), gap).alias("sw")).agg(*aggs)
    return g.select(*keys, F.col("sw.start").alias("session_start"), F.col("sw.end").alias("session_end"),
                    *[c for c in g.columns if c not in (*keys, "sw")])


def running_count(df: DataFrame, predicate: Column, name: str = "n") -> DataFrame:
    """Stateless filter + running total count (complete mode)."""
    return df.where(predicate).agg(F.count(F.lit(1)).alias(name))


def deduplicated(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each ``key`` once, for a source that delivers at least once.

    ``df`` has a watermark: a key is remembered until the watermark is its
    row's event time plus the delay, so the state holds the keys of one delay,
    and a copy that comes later than that is behind the watermark and dropped.
    """
    return df.dropDuplicatesWithinWatermark(list(key))


# ------------------------------------------------------------------- sinks

def batch_name(name: str, batch: DataFrame, batch_id: int) -> str:
    """Batch ids restart with every new checkpoint, so the query's id, which
    lives in the checkpoint, is part of a micro-batch's name."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{name}-{query or 'batch'}-{batch_id}"


def _default_checkpoint(store: TableStore, name: str) -> str:
    """Next to the table's data, so that a job started again without naming a
    checkpoint goes on after its last commit."""
    return f"{store.path}/_checkpoints/{name}"


def upsert_sink(store: TableStore, key: Sequence[str], name: str,
                unique_source: bool = True) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: keyed upsert.  A batch that is replayed after a
    failure upserts the same rows again, which changes nothing.
    ``unique_source``: the batch is unique on ``key`` (true for the output of a
    streaming aggregation grouped by ``key``), so no duplicate check runs."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        store.merge_upsert(batch, key, check_unique=not unique_source)
    handle.checkpoint = _default_checkpoint(store, name)
    return handle


def append_sink(store: TableStore, name: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` append, exactly once: a replayed batch replaces the
    partition that it wrote before."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        store.append(batch, batch=batch_name(name, batch, batch_id))
    handle.checkpoint = _default_checkpoint(store, name)
    return handle


def jdbc_append_sink(url: str, table: str, properties: dict | None = None,
                     batchsize: int = 1000) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` append into an RDBMS table (at-least-once; pair with a
    keyed upsert on the database side for exactly-once)."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.option("batchsize", batchsize).jdbc(url, table, mode="append", properties=properties or {})
    return handle


def start(df: DataFrame, *, sink: Callable[[DataFrame, int], None] | None = None, fmt: str | None = None,
          path: str | None = None, mode: str = "append", name: str | None = None,
          checkpoint: str | None = None, processing_time: str | None = "10 seconds",
          available_now: bool = False, rocksdb: bool = True) -> StreamingQuery:
    """Start a streaming query.

    Without ``checkpoint`` a table sink keeps it beside its table and a file
    sink below its path, so a restart with defaults continues where the last
    run committed; the console, which keeps nothing, starts anew each time;
    any other sink must name one.
    ``available_now`` processes what is there and stops (tests, backfills);
    otherwise micro-batches run every ``processing_time``.
    """
    spark = df.sparkSession
    if rocksdb and not spark.conf.get("spark.sql.streaming.stateStore.providerClass", None):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    name = name or f"q_{uuid.uuid4().hex[:8]}"
    if checkpoint is None:
        if sink is not None:
            checkpoint = getattr(sink, "checkpoint", None)
        elif fmt == "console":
            checkpoint = scratch_path(spark, f"streams/{name}")
        elif path:
            checkpoint = f"{path.rstrip('/')}/_checkpoint"
        if checkpoint is None:
            raise ValueError("this sink needs a checkpoint: without one a restart would read everything again")
    w = df.writeStream.outputMode(mode).queryName(name).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    if sink is not None:
        return w.foreachBatch(sink).start()
    if fmt == "console":
        return w.format("console").start()
    return w.format(fmt or "parquet").start(path)
