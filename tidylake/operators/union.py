"""Union by column name."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Bag union matching columns by name, in the first frame's order.

    A column missing from one side is an error unless ``allow_missing`` (then
    it is null there).  No shuffle: the result has the inputs' partitions.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
