"""Totals over trailing periods, for each entity and every day, active or not.

Amounts are summed per entity and day first (map-side, so a hot entity shrinks to one row a day), then each partition
holds whole entities sorted by day. A two-stack queue keeps the active window: the back stack holds the running
aggregate of what was pushed since the last flip, the front stack the suffix aggregates of what was there at the flip.
With one push a day the queue flips every ``window`` pushes, so for many entities at once both stacks are prefix and
suffix scans over blocks of ``window`` days. Only associativity is used, never an inverse: minimum, maximum or any
other monoid work like the sum.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB = 2**40  # sums of decimals travel as two 64-bit limbs
CELLS = 1_000_000  # cells of one block of entities x days


class TwoStackQueue:
    """The queue for one entity and an arbitrary monoid; push, evict and read cost O(1) amortised."""

    def __init__(self, combine: Callable, identity):
        self.combine, self.identity = combine, identity
        self.front: list = []  # (value, aggregate of it and all below), oldest on top
        self.back: list = []
        self.back_total = identity

    def push(self, value) -> None:
        self.back.append(value)
        self.back_total = self.combine(self.back_total, value)

    def evict(self) -> None:
        if not self.front:
            total = self.identity
            while self.back:
                total = self.combine(self.back.pop(), total)
                self.front.append(total)
            self.back_total = self.identity
        self.front.pop()

    def read(self):
        return self.combine(self.front[-1] if self.front else self.identity, self.back_total)

    def __len__(self) -> int:
        return len(self.front) + len(self.back)


def two_stack_scan(x: np.ndarray, window: int, combine: np.ufunc, identity) -> np.ndarray:
    """Aggregate of the ``window`` columns that end with each column, for every row of ``x``."""
    rows, days = x.shape
    blocks = -(-days // window)
    padded = np.full((rows, blocks * window), identity, dtype=x.dtype)
    padded[:, :days] = x
    cube = padded.reshape(rows, blocks, window)
    back = combine.accumulate(cube, axis=2)
    front = combine.accumulate(cube[:, :, ::-1], axis=2)[:, :, ::-1]
    out = back.copy()
    if blocks > 1 and window > 1:
        out[:, 1:, :-1] = combine(front[:, :-1, 1:], back[:, 1:, :-1])
    return out.reshape(rows, blocks * window)[:, :days]


def _dense(entity: np.ndarray, day: np.ndarray, columns: Sequence[np.ndarray], identities: Sequence, last: int):
    """Blocks of whole entities as matrices with one column a day, from each entity's first day to ``last``."""
    starts = np.flatnonzero(np.r_[True, entity[1:] != entity[:-1]])
    ends = np.r_[starts[1:], len(entity)]
    begun = day[starts]
    at = 0
    while at < len(starts):
        longest, to = 0, at
        while to < len(starts):
            longest_next = max(longest, int(last - begun[to]) + 1)
            if to > at and longest_next * (to - at + 1) > CELLS:
                break
            longest, to = longest_next, to + 1
        lo, hi = starts[at], ends[to - 1]
        row = np.repeat(np.arange(to - at), ends[at:to] - starts[at:to])
        col = day[lo:hi] - np.repeat(begun[at:to], ends[at:to] - starts[at:to])
        mats = []
        for values, identity in zip(columns, identities):
            m = np.full((to - at, longest), identity, dtype=values.dtype)
            m[row, col] = values[lo:hi]
            mats.append(m)
        yield entity[starts[at:to]], begun[at:to], (last - begun[at:to] + 1).astype(np.int64), mats
        at = to


def _whole_entities(batches: Iterator[pa.RecordBatch], rows: int = 65_536) -> Iterator[pa.Table]:
    """Tables that end where an entity ends; an entity has one row a day, so the remainder stays small."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        rest = t if rest is None else pa.concat_tables([rest, t])
        if rest.num_rows < rows:
            continue
        names = rest["entity"].combine_chunks()
        final = names[-1].as_py()
        keep = len(names)
        while keep and names[keep - 1].as_py() == final:
            keep -= 1
        if keep:
            yield rest.slice(0, keep)
            rest = rest.slice(keep)
    if rest is not None and rest.num_rows:
        yield rest


def daily_sums(df: DataFrame, entity: Column, time: str, amount: str) -> DataFrame:
    """One row per entity and UTC day: total (decimal), largest amount, number of rows.

    Null amounts count as 0. Rows without entity or time are left out: they belong to no entity or no day.
    """
    return (
        df.select(
            entity.alias("entity"),
            F.unix_date(F.to_date(F.col(time))).alias("day"),
            F.coalesce(F.col(amount).cast("decimal(19,7)"), F.lit(0).cast("decimal(19,7)")).alias("a"),
        )
        .filter(F.col("entity").isNotNull() & F.col("day").isNotNull())
        .groupBy("entity", "day")
        .agg(F.sum("a").cast("decimal(29,7)").alias("total"), F.max("a").alias("largest"), F.count("*").alias("n"))
    )


def rolling_windows(daily: DataFrame, windows: Sequence[int], last_day: int | None = None, peaks: bool = False) -> DataFrame:
    """Trailing totals of ``daily`` (see daily_sums) for every entity, window and day up to ``last_day``.

    The series of an entity begins with its first day and ends with ``last_day`` (days since 1970-01-01; default: the
    last day in ``daily``); days without rows count 0. Result: entity, window_days, day (int), total decimal(31,7),
    average double, largest decimal(19,7), n. With ``peaks`` only the day with the highest total of each
    entity and window comes out, the earliest of equals; the comparison is exact. An empty input gives an empty result.
    """
    if any(w < 1 for w in windows):
        raise ValueError("a window has at least one day")
    windows = tuple(int(w) for w in windows)
    if last_day is None:
        last_day = daily.agg(F.max("day")).head()[0]
        if last_day is None:
            last_day = 0
    unscaled = "cast(total * 10000000BD as decimal(38,0))"
    more = [] if peaks else [F.expr("largest div 1").alias("whole"), F.expr("cast((largest % 1) * 10000000BD as bigint)").alias("part"), "n"]
    columns = daily.filter(F.col("day") <= last_day).select(
        "entity", "day", F.expr(f"{unscaled} div {LIMB}BD").alias("high"), F.expr(f"cast({unscaled} % {LIMB}BD as bigint)").alias("low"), *more
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiny = np.iinfo(np.int64).min
        for t in _whole_entities(batches):
            names = t["entity"].combine_chunks().dictionary_encode()
            code = names.indices.to_numpy(zero_copy_only=False)
            get = lambda c: t[c].to_numpy().astype(np.int64)
            cols, ids = [get("high"), get("low")], [0, 0]
            if not peaks:
                rank, whole, part = _ranked(get("whole"), get("part"))
                cols, ids = [*cols, rank, get("n")], [0, 0, -1, 0]
            for who, begun, length, mats in _dense(code, get("day"), cols, ids, last_day):
                for w in windows:
                    high = two_stack_scan(mats[0], w, np.add, 0)
                    low = two_stack_scan(mats[1], w, np.add, 0)
                    high, low = high + low // LIMB, low % LIMB
                    valid = np.arange(high.shape[1]) < length[:, None]
                    if peaks:
                        # The highest high limb, among those the highest low limb; argmax takes the first of equals.
                        top = np.where(valid, high, tiny).max(axis=1)
                        best = np.where(valid & (high == top[:, None]), low, -1).argmax(axis=1)
                        yield _batch(names, who, w, begun + best, {})
                        continue
                    r, c = np.nonzero(valid)
                    top = two_stack_scan(mats[2], w, np.maximum, -1)[r, c]
                    n = two_stack_scan(mats[3], w, np.add, 0)[r, c]
                    none = top < 0
                    yield _batch(names, who[r], w, begun[r] + c, {"high": pa.array(high[r, c]), "low": pa.array(low[r, c]), "whole": pa.array(whole[top], mask=none), "part": pa.array(part[top], mask=none), "n": pa.array(n)})

    parted = columns.repartition("entity").sortWithinPartitions("entity", "day")
    if peaks:
        return parted.mapInArrow(run, "entity string, window_days int, day int")
    out = parted.mapInArrow(run, "entity string, window_days int, day int, high bigint, low bigint, whole bigint, part bigint, n bigint")
    total = f"cast(cast(cast(high as decimal(19,0)) * {LIMB}BD + low as decimal(30,0)) * 0.0000001BD as decimal(31,7))"
    return out.select(
        "entity",
        "window_days",
        "day",
        F.expr(total).alias("total"),
        F.expr(f"cast({total} as double) / window_days").alias("average"),
        F.expr("cast(cast(whole as decimal(12,0)) + cast(part as decimal(7,0)) * 0.0000001BD as decimal(19,7))").alias("largest"),
        "n",
    )


def _ranked(whole: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank of each pair, and the pairs by rank: a decimal(19,7) doesn't fit one 64-bit integer."""
    order = np.lexsort((part, whole))
    w, p = whole[order], part[order]
    step = np.r_[False, (w[1:] != w[:-1]) | (p[1:] != p[:-1])] if len(w) else np.zeros(0, bool)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(step)
    first = np.r_[True, step[1:]] if len(w) else step
    return rank, w[first], p[first]


def _batch(names: pa.DictionaryArray, who: np.ndarray, window: int, day: np.ndarray, more: dict[str, pa.Array]) -> pa.RecordBatch:
    base = {"entity": names.dictionary.take(pa.array(who)), "window_days": pa.array(np.full(len(who), window), pa.int32()), "day": pa.array(day, pa.int32())}
    return pa.RecordBatch.from_pydict(base | more)
