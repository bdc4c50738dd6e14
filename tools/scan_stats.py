"""Bytes a query's Parquet scans request, computed like a warehouse's
"bytes processed": the compressed size of the column chunks of the columns
each scan reads (its pruned ``requiredSchema``), over the files left after
partition pruning.  Read from the executed plan and the Parquet footers; a
``COUNT(*)`` that needs no column reads 0 bytes.

Benchmark/diagnostic tooling: it reads file footers on the driver, so use
it on test-sized inputs, not as part of a production job."""

from __future__ import annotations

from functools import lru_cache

import pyarrow.parquet as pq
from pyspark.sql import DataFrame


def _iter(seq):
    """Iterate a Scala collection or a Java array handed over by py4j."""
    from py4j.java_collections import JavaArray
    if isinstance(seq, (JavaArray, list, tuple)):
        yield from seq
        return
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def _scans(node):
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _scans(node.executedPlan())
        return
    if name.endswith("QueryStageExec"):
        yield from _scans(node.plan())
        return
    if name == "ReusedExchangeExec":
        return
    if name == "FileSourceScanExec":
        yield node
    for child in _iter(node.children()):
        yield from _scans(child)


@lru_cache(maxsize=4096)
def _column_bytes(path: str) -> dict[str, int]:
    md = pq.ParquetFile(path).metadata
    out: dict[str, int] = {}
    for rg in range(md.num_row_groups):
        g = md.row_group(rg)
        for c in range(g.num_columns):
            ch = g.column(c)
            top = ch.path_in_schema.split(".")[0]
            out[top] = out.get(top, 0) + ch.total_compressed_size
    return out


def scan_bytes(df: DataFrame, run: bool = True) -> int:
    """Run ``df`` (noop sink) and return the column bytes its scans request."""
    if run:
        df.write.format("noop").mode("overwrite").save()
    total = 0
    for scan in _scans(df._jdf.queryExecution().executedPlan()):
        cols = {c.lower() for c in scan.requiredSchema().fieldNames()}
        for pdir in _iter(scan.selectedPartitions().partitionDirectories()):
            for f in _iter(pdir.files()):
                path = f.getPath().toUri().getPath()
                total += sum(b for c, b in _column_bytes(path).items() if c.lower() in cols)
    return total
