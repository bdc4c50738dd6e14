"""Reports kept up to date from mergeable partial states.

A batch adds, per group, the sums and counts of its own rows, a small table that
is appended under the batch's name.  Nothing that was loaded before is read
again; a batch that is loaded again replaces its own partials.  Reading merges
the partials of each group and finishes averages as sum over count.
:meth:`Partials.compact` merges the partials of finished batches into one row
per group.

A row must belong to one batch only: de-duplicate across batches before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.table_store import TableStore


class Partials:
    """``states`` maps a state's name to ``(aggregate of a batch's rows, how two
    states merge)``: ``F.sum`` for sums and counts, ``F.min``, ``F.max``."""

    def __init__(self, spark: SparkSession, path: str, keys: Mapping[str, Column], states: Mapping[str, tuple[Column, object]],
                 partition_by: Sequence[str] = ()):
        self.store = TableStore(spark, path, partition_by)
        self.keys, self.states = dict(keys), dict(states)

    def of(self, rows: DataFrame) -> DataFrame:
        """The partial states of some rows."""
        g = rows.groupBy(*[c.alias(k) for k, c in self.keys.items()])
        return g.agg(*[agg.alias(name) for name, (agg, _) in self.states.items()])

    def add(self, rows: DataFrame, batch: str) -> None:
        self.store.append(self.of(rows), batch=batch)

    def merged(self) -> DataFrame:
        """One state per group over all batches."""
        table = self.store.read()
        types = dict(table.dtypes)
        return table.groupBy(*self.keys).agg(*[merge(name).cast(types[name]).alias(name) for name, (_, merge) in self.states.items()])

    def compact(self) -> None:
        """One row per group from now on; batches before can't be replaced any more."""
        self.store.overwrite(self.merged())
