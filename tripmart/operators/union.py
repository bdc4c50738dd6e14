"""Set operators: UNION ALL by name (ragged schemas allowed)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL matched by column name.  By-position ``union`` would silently
    coerce mismatched columns, so it is not offered.  ``allow_missing`` fills
    columns absent on one side with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
