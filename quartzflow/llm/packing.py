"""Fill containers of fixed capacity with items of varying size: bounded-space online best fit.

Each task packs the items of its own partition, so nothing but sizes leaves the scan and nothing is shuffled. A fixed
number of bins is open; a bitset has a bit for every amount of free space that some open bin has, so the tightest bin
that fits is the lowest bit set at or above the item's size. If none fits and no more may be opened, the fullest
closes first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_BINS = 64
BITS = 65_536  # of the bitset at most; larger capacities are graded more coarsely


class OpenBins:
    """Open bins of one kind of container."""

    def __init__(self, capacity: int, most: int = OPEN_BINS):
        if capacity < 1 or most < 1:
            raise ValueError("a container has room for one unit at least, and one bin is open at least")
        self.capacity, self.most = capacity, most
        self.grain = -(-(capacity + 1) // BITS)
        self.bits = 0  # bit g: some open bin has at least g * grain free, and less than (g + 1) * grain
        self.at: dict[int, list[tuple[int, int]]] = {}  # grade -> (bin, free)
        self.open = self.next = 0

    def place(self, size: int) -> int:
        """The bin for an item of at most the capacity."""
        grade = -(-size // self.grain)
        above = self.bits >> grade
        if above:
            grade += (above & -above).bit_length() - 1
            number, free = self._take(grade)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
                self.open -= 1
            number, free = self.next, self.capacity
            self.next += 1
            self.open += 1
        self._put(number, free - size)
        return number

    def full(self) -> int:
        """A bin of its own, filled to the brim."""
        self.next += 1
        return self.next - 1

    def _take(self, grade: int) -> tuple[int, int]:
        bins = self.at[grade]
        found = bins.pop()
        if not bins:
            del self.at[grade]
            self.bits &= ~(1 << grade)
        return found

    def _put(self, number: int, free: int) -> None:
        if free == 0:
            self.open -= 1
            return
        grade = free // self.grain
        self.at.setdefault(grade, []).append((number, free))
        self.bits |= 1 << grade


def pack(items: DataFrame, item: str, size: Column, kinds: Sequence[tuple[str, int]], open_bins: int = OPEN_BINS) -> DataFrame:
    """Contents of the containers of every kind: container, bin, item, part, parts, size.

    An item larger than the capacity is cut into full containers and a rest that is packed like any item; all others
    stay whole. Items of null size, or smaller than 1, are not packed. Kinds without a capacity of 1 at least hold
    nothing. Bins are named by the task's partition and a number within it. Repeated items are packed repeatedly.
    """
    kinds = [(name, int(capacity)) for name, capacity in kinds if capacity is not None and capacity >= 1]
    kind = items.schema[item].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        states = [(name, OpenBins(capacity, open_bins)) for name, capacity in kinds]
        for b in batches:
            sizes = b.column("__size").to_pylist()
            for name, state in states:
                capacity, place, full = state.capacity, state.place, state.full
                index, bins, part, parts, took = [], [], [], [], []
                for j, s in enumerate(sizes):
                    if s <= capacity:
                        index.append(j)
                        bins.append(place(s))
                        part.append(0)
                        parts.append(1)
                        took.append(s)
                        continue
                    n = -(-s // capacity)
                    for p in range(n):
                        left = min(capacity, s - p * capacity)
                        index.append(j)
                        bins.append(full() if left == capacity else place(left))
                        part.append(p)
                        parts.append(n)
                        took.append(left)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(index), pa.string()), pa.array([f"{task}-{x}" for x in bins], pa.string()), b.column("__item").take(pa.array(index, pa.int64())), pa.array(part, pa.int32()), pa.array(parts, pa.int32()), pa.array(took, pa.int64())],
                    names=["container", "bin", "item", "part", "parts", "size"],
                )

    src = items.select(F.col(item).alias("__item"), size.cast("bigint").alias("__size")).filter(F.col("__size") >= 1)
    return src.mapInArrow(run, f"container string, bin string, item {kind}, part int, parts int, size bigint").withColumnRenamed("item", item)


def fill_report(packed: DataFrame, kinds: DataFrame) -> DataFrame:
    """Containers, items and share of the capacity in use, by kind (container, capacity_tokens)."""
    bins = packed.groupBy("container", "bin").agg(F.sum("size").alias("used"), F.count("*").alias("n"))
    per = bins.groupBy("container").agg(F.count("*").alias("n_bins"), F.sum("n").alias("n_items"), F.sum("used").alias("used"))
    return per.join(F.broadcast(kinds), "container").select("container", "n_bins", "n_items", "used", (F.col("used") / (F.col("n_bins") * F.col("capacity_tokens"))).alias("fill"))
