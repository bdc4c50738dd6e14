"""Paged sources: endpoints read as a Spark Python Data Source, saved pages as files.

Two paging styles:

* ``kind="page"``: ``?page=N`` from 1 upwards, the first empty page ends the
  data.  For an endpoint the driver finds that page with O(log n) probes
  (doubling, then bisection) unless ``pages`` declares the count, and the
  pages before it are split into ranges, one input partition per range.  Pages
  must be contiguous: an empty page before the end found is an error.
* ``kind="offset"``: ``?offset=O&limit=L``; an endpoint's first response
  carries the total count and partitions are its offsets.  Without a total the
  first empty offset is found as for pages.  Saved pages end at the first that
  is missing or empty, whatever total they were saved with.

There is no cap unless the caller passes one (``max``, rows of an offset
source).  Only a page without records ends the data; any failure to read or
parse a page is an error.

``url`` is a template with ``{page}`` (and ``{size}``) or ``{offset}`` /
``{limit}``.  ``http(s)`` templates are fetched by tasks; any other template
names saved pages on a file system that Spark reads (one or more files per
page, globs allowed), and is planned as an ordinary scan.  A page body is a
JSON list of records or an object whose ``records_field`` (default ``data``)
holds the list and ``total_field`` (default ``total``) the total.
"""

from __future__ import annotations

import json
import re
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

DEFAULTS = {"page_size": 1000, "pages_per_partition": 10, "limit": 100, "records_field": "data", "total_field": "total"}


def _fetch(url: str):
    with urllib.request.urlopen(url, timeout=60) as r:  # noqa: S310 - user-supplied endpoint
        return json.loads(r.read().decode())


def _records(body, field: str):
    if isinstance(body, dict):
        body = body[field]
    return body or []


class _Range(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class PagedReader(DataSourceReader):
    """Pages ``1..n`` of an endpoint; an offset source's page p is offset ``(p - 1) * limit``."""

    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        self.o = {**DEFAULTS, **options}
        self.by_page = self.o.get("kind", "page") == "page"
        self.limit = int(self.o["limit"])
        self.cap = int(self.o["max"]) if "max" in self.o else None

    def _get(self, page: int):
        if self.by_page:
            return _fetch(self.o["url"].format(page=page, size=self.o["page_size"]))
        return _fetch(self.o["url"].format(offset=(page - 1) * self.limit, limit=self.limit))

    def _empty(self, page: int) -> bool:
        return not _records(self._get(page), self.o["records_field"])

    def _first_empty_page(self) -> int:
        lo, hi = 0, 1          # page lo holds records (or is 0), page hi is unknown
        while not self._empty(hi):
            lo, hi = hi, hi * 2
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self._empty(mid) else (mid, hi)
        return hi

    def _pages(self) -> int:
        if "pages" in self.o:
            return int(self.o["pages"])
        rows = None
        if not self.by_page:
            first = self._get(1)
            total = first.get(self.o["total_field"]) if isinstance(first, dict) else None
            rows = min((int(x) for x in (total, self.cap) if x is not None), default=None) if total is not None else None
        if rows is not None:
            return -(-rows // self.limit)
        pages = self._first_empty_page() - 1
        return pages if self.by_page or self.cap is None else min(pages, -(-self.cap // self.limit))

    def partitions(self):
        per, end = int(self.o["pages_per_partition"]) if self.by_page else 1, self._pages()
        return [_Range(p, min(p + per - 1, end)) for p in range(1, end + 1, per)]

    def _batch(self, recs: list):
        """One Arrow record batch per page (fields picked by name, absent -> null)."""
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(self.schema)
        cols = {f.name: [r.get(f.name) for r in recs] for f in self.schema.fields}
        return pa.RecordBatch.from_pydict(cols, schema=schema)

    def read(self, partition: _Range) -> Iterator:
        for page in range(partition.first, partition.last + 1):
            recs = _records(self._get(page), self.o["records_field"])
            if not recs:
                raise ValueError(f"page {page} is empty but a later page is not; declare the count with pages=")
            if not self.by_page and self.cap is not None:
                recs = recs[:max(0, self.cap - (page - 1) * self.limit)]
            yield self._batch(recs)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self):
        raise ValueError("the paged source needs a declared schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(schema, dict(self.options))


def _ddl(schema: StructType | str) -> str:
    if isinstance(schema, str):
        return schema
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _saved(spark: SparkSession, url: str, schema: StructType | str, kind: str, options: dict) -> DataFrame:
    """Pages saved as files: one scan, the page number taken from the path."""
    o = {**DEFAULTS, **options}
    by_page, ddl = kind == "page", _ddl(schema)
    name = "{page}" if by_page else "{offset}"
    known = url.replace("{size}", str(o["page_size"])).replace("{limit}", str(o["limit"]))
    before, after = known.split(name)
    # the number stands between the last folder-level text before and the text after, up to a glob
    lead, tail = re.split(r"[*?\[]", before)[-1], re.split(r"[*?\[]", after)[0]
    number = re.escape(lead.rsplit("/", 1)[-1]) + r"(\d+)" + re.escape(tail)
    folder = {m[0] for m in re.finditer(r"[^/]+=\{(?:page|offset)\}", known)}
    # files below "x={page}" are a partitioned folder: read as files, not as partitions
    files = spark.read.option("recursiveFileLookup", bool(folder)).text(before + "*" + after, wholetext=True)
    body = (files.select(F.regexp_extract("_metadata.file_path", number, 1).cast("long").alias("n"), F.trim("value").alias("v"))
            .where("n IS NOT NULL"))
    fail = {"mode": "FAILFAST"}
    field, total = o["records_field"], o["total_field"]
    listed = F.from_json("v", f"array<struct<{ddl}>>", fail)
    held = F.from_json("v", f"struct<`{field}`: array<struct<{ddl}>>, `{total}`: long>", fail)
    pages = body.select("n", F.when(F.col("v").startswith("["), listed).otherwise(held[field]).alias("recs"))
    step = 1 if by_page else int(o["limit"])
    if "pages" in o:
        end = step * int(o["pages"]) + (1 if by_page else 0)
    else:  # the first number after a page with records that has none itself
        filled = pages.where(F.size("recs") > 0).select("n").distinct()
        start = spark.range(1).select((F.lit(1 if by_page else 0)).cast("long").alias("n"))
        follow = start.union(filled.select(F.col("n") + step))
        end = follow.join(filled, "n", "left_anti").agg(F.min("n")).first()[0]
    rows = pages.where(F.col("n") < end).select("n", F.posexplode("recs").alias("i", "r"))
    if not by_page and "max" in o:
        rows = rows.where(F.col("n") + F.col("i") < int(o["max"]))
    return rows.select("r.*")


def paged_scan(spark: SparkSession, url: str, schema: StructType | str, kind: str = "page", **options) -> DataFrame:
    """Read a paged endpoint, or its saved pages, into a DataFrame."""
    if not url.startswith(("http://", "https://")):
        return _saved(spark, url, schema, kind, options)
    spark.dataSource.register(PagedSource)
    r = spark.read.format("paged").schema(schema).option("url", url).option("kind", kind)
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load()
