"""One value from those of all partitions, merged by executors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from functools import reduce
from typing import TypeVar

from pyspark import RDD

T = TypeVar("T")

#: Values that one task merges, up to which there is no level between.
AT_ONCE = 16


def reduced(values: RDD, merge: Callable[[T, T], T]) -> T:
    """The merge of one value per partition, in their order; it alone reaches the driver, whatever the number of partitions."""
    parts = values.getNumPartitions()

    def joined(found: Iterable[tuple[int, T]]) -> tuple[int, T]:
        ordered = sorted(found, key=lambda one: one[0])
        return ordered[0][0], reduce(merge, (value for _, value in ordered))

    def level(numbered: RDD, groups: int, size: int) -> RDD:
        return numbered.map(lambda one: (one[0] // size, one)).groupByKey(groups).values().map(joined)

    if parts == 1:
        return reduce(merge, values.collect())
    numbered = values.mapPartitionsWithIndex(lambda i, held: ((i, value) for value in held))
    if parts > AT_ONCE:
        size = math.isqrt(parts - 1) + 1
        numbered = level(numbered, -(-parts // size), size)
    return level(numbered, 1, parts).collect()[0][1]
