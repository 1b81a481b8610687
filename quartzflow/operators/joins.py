"""Joins by time: round trips, synchrony, co-activity, as-of and interval joins.

A pure range condition makes Catalyst compare all pairs. Here one side is put into time buckets as wide as the window
and the other looks into its own and the next buckets, so the join is an equi-join with the exact condition left as a
residual. Where only the existence of a neighbour matters a window frame answers without any join.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quartzflow.session import read_blocks, scratch_path, told_apart, written

SECOND = 1_000_000
DAY = 86_400 * SECOND
VALID = "^G[A-Z2-7]{55}$"


def bucket(ts: Column, width_us: int) -> Column:
    return F.floor(F.unix_micros(ts) / width_us).cast("bigint")


def interval_join(left: DataFrame, right: DataFrame, on: list[str], before_us: int, after_us: int, ts: str = "ts", right_ts: str = "right_ts") -> DataFrame:
    """Pairs with equal ``on`` whose right time lies in [left - before, left + after]; the right side has its own names but for ``on``."""
    width = max(1, before_us + after_us)
    lo, hi = bucket(F.timestamp_micros(F.unix_micros(ts) - before_us), width), bucket(F.timestamp_micros(F.unix_micros(ts) + after_us), width)
    probe = left.withColumn("__b", F.explode(F.sequence(lo, hi)))
    base = right.withColumn("__b", bucket(F.col(right_ts), width))
    gap = F.unix_micros(right_ts) - F.unix_micros(ts)
    return probe.join(base, [*on, "__b"]).filter(gap.between(-before_us, after_us)).drop("__b")


def round_trips(trades: DataFrame, window_us: int, tolerance: float) -> DataFrame:
    """Trades followed, within the window, by one between the same accounts turned round, of nearly the same amount and base asset."""
    need = trades.filter("base <> counter and amount > 0 and ts is not null")
    fwd = need.select("trade_id", "base", "counter", "base_asset", "ts", "amount")
    # The accounts of the return are swapped, so the swapped names are the key.
    ret = need.select(F.col("counter").alias("base"), F.col("base").alias("counter"), "base_asset", F.col("ts").alias("right_ts"), F.col("trade_id").alias("return_id"), F.col("amount").alias("return_amount"))
    j = interval_join(fwd, ret, ["base", "counter", "base_asset"], 0, window_us)
    near = F.abs(F.col("amount") - F.col("return_amount")) <= F.greatest("amount", "return_amount").cast("double") * tolerance
    return j.filter((F.col("right_ts") > F.col("ts")) & near).select("trade_id", "return_id", "base", "counter")


def synchrony(sides: DataFrame, seconds: int) -> DataFrame:
    """Share of a wallet's trades with a trade of it on another pair within so many seconds either way."""
    w = Window.partitionBy("wallet").orderBy(F.unix_micros("ts")).rangeBetween(-seconds * SECOND, seconds * SECOND)
    near = (F.min("pair").over(w) != F.max("pair").over(w)).cast("int")
    return sides.filter("pair is not null").select("wallet", near.alias("x")).groupBy("wallet").agg(F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("pair_synchrony"))


def venue_synchrony(sides: DataFrame, seconds: int) -> DataFrame:
    """Share of a wallet's pool trades with an order-book trade of it within so many seconds either way."""
    w = Window.partitionBy("wallet").orderBy(F.unix_micros("ts")).rangeBetween(-seconds * SECOND, seconds * SECOND)
    hit = F.max((F.col("venue") == "sdex").cast("int")).over(w)
    return sides.select("wallet", "venue", hit.alias("x")).filter("venue = 'amm'").groupBy("wallet").agg(F.round(F.avg("x"), 6).alias("venue_synchrony"))


def co_trades(trades: DataFrame, window_us: int) -> DataFrame:
    """Unordered pairs of wallets active on a pair within the window of each other, with the number of meetings and the latest."""
    who = trades.select("pair", "ts", F.explode(F.array_distinct(F.array_compact(F.array("base", "counter")))).alias("wallet"))
    # One row per wallet and moment, so repeated activity in a moment doesn't multiply.
    who = who.filter("pair is not null").distinct()
    other = who.select("pair", F.col("ts").alias("right_ts"), F.col("wallet").alias("other"))
    j = interval_join(who, other, ["pair"], window_us, window_us).filter("wallet < other")
    return j.groupBy(F.col("wallet").alias("src"), F.col("other").alias("dst")).agg(F.count("*").alias("weight"), F.unix_micros(F.max(F.greatest("ts", "right_ts"))).alias("latest"))


def weighted_co_trades(trades: DataFrame, window_us: int) -> DataFrame:
    """Unordered pairs of valid wallets with the number of trades followed, within the window, by activity of both on the pair, and the latest such trade.

    In a bucket as wide as the window a wallet leaves out only the trades after its last activity and before the time its
    first activity of the next bucket reaches back to: one gap of ranks. The trades that two wallets share in a bucket
    follow from their gaps. Trades of one moment see each other. Wallets and pairs move as hashes and couples of wallets
    not at all: a trade is shuffled once, with its pair and time, and a gap once, packed with others of its block of
    wallets. The blocks lie in the shared folder; a task reads two at a time and couples their wallets.
    """
    spark = trades.sparkSession
    t = trades.filter("pair is not null and ts is not null").select("pair", F.unix_micros("ts").alias("us"), "base", "counter")
    valid = F.filter(F.array_distinct(F.array_compact(F.array("base", "counter"))), lambda w: w.rlike(VALID))
    names, h = told_apart(t.select(F.explode(valid).alias("wallet")).groupBy("wallet").agg(F.count("*").alias("n")), "wallet")
    _, pair = told_apart(t.select("pair").distinct(), "pair")
    wallets, sides = names.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).head()
    blocks = max(BLOCKS, -(-wallets // WALLETS), -(-2 * sides // GAPS))
    b = F.floor(F.col("us") / window_us).cast("bigint")
    # Spans of some buckets; the first bucket of the next span is needed as well.
    span = F.floor(b / SPAN).cast("bigint")
    at = F.when(b % SPAN == 0, F.array(span, span - 1)).otherwise(F.array(span))
    who = F.transform(valid, lambda w: h(w))
    t = t.select(pair("pair").alias("pair"), F.explode(at).alias("span"), "us", F.get(who, F.lit(0)).alias("a"), F.get(who, F.lit(1)).alias("c"))
    gaps = t.repartition("pair", "span").sortWithinPartitions("pair", "span", "us").mapInArrow(lambda it: _gaps(it, window_us, blocks), "block int, " + ", ".join(f"{c} array<{k}>" for c, k in GAP.items()))
    of = _by_block(gaps, "gaps"), _by_block(names.select(F.pmod(h("wallet"), F.lit(blocks)).cast("int").alias("block"), h("wallet").alias("w"), "wallet"), "wallets")
    couples = len(of[1]) * (len(of[1]) + 1) // 2
    tasks = max(1, min(couples, 4 * spark.sparkContext.defaultParallelism), -(-couples // COUPLES))
    return spark.range(0, couples, 1, tasks).mapInArrow(lambda it: _co_traded(it, *of, window_us), "src string, dst string, weight bigint, latest bigint")


GAP = {"pair": "bigint", "b": "bigint", "w": "bigint", "p": "int", "q": "int", "hi": "bigint", "m": "int", "last": "bigint"}
SPAN = 4  # buckets that a task orders together
BLOCKS = 8  # at least
WALLETS = 2048  # of a block
GAPS = 1 << 20  # of a block
COUPLES = 6  # of blocks that a task takes; the names in its result stay few enough for a dictionary
ROWS = 1 << 18  # trades whose gaps are found at once
DENSE = 1024  # couples of wallets in a bucket from which it is worth its own arrays
NEVER = -(1 << 63)


def _by_block(df: DataFrame, name: str) -> dict[int, list[str]]:
    """Write ``df`` to the shared folder: the files of each block."""
    path = scratch_path(df.sparkSession, name)
    df.repartition("block").write.partitionBy("block").parquet(path)
    files = defaultdict(list)
    for file in df.sparkSession.read.schema(df.schema).parquet(path).inputFiles():
        files[int(re.search(r"/block=(\d+)/", file)[1])].append(file)
    return dict(files)


def _gaps(batches: Iterator[pa.RecordBatch], window_us: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """Gaps of the wallets in trades ordered by pair, span and time, as lists by block."""
    import numpy as np

    held, rows = [], 0
    for x in batches:
        if not x.num_rows:
            continue
        held, rows = [*held, x], rows + x.num_rows
        if rows >= ROWS:
            # What a later batch may go on with waits.
            t = pa.Table.from_batches(held).combine_chunks()
            pair, span = t["pair"].to_numpy(), t["span"].to_numpy()
            other = np.flatnonzero((pair != pair[-1]) | (span != span[-1]))
            if len(other):
                yield from _gaps_of(t[: other[-1] + 1], window_us, blocks)
                t = t[other[-1] + 1 :]
            held, rows = t.to_batches(), 0
    if held:
        yield from _gaps_of(pa.Table.from_batches(held), window_us, blocks)


def _gaps_of(t: pa.Table, window_us: int, blocks: int) -> Iterator[pa.RecordBatch]:
    import numpy as np

    t = t.combine_chunks()
    pair, span, us = (t[c].to_numpy() for c in ("pair", "span", "us"))
    b = us // window_us
    new = np.r_[True, (np.diff(pair) != 0) | (np.diff(span) != 0) | (np.diff(b) != 0)]
    run, start = np.cumsum(new) - 1, np.flatnonzero(new)
    m = np.diff(np.r_[start, len(us)])
    pairs, spans, b, last = pair[start], span[start], b[start], us[start + m - 1]
    place = run * window_us + us - b[run] * window_us  # rises from row to row
    # First and last activity of each wallet in each run.
    some = [~np.asarray(t[c].is_null()) for c in ("a", "c")]
    w = np.concatenate([t[c].drop_null().to_numpy() for c in ("a", "c")])
    r, at = (np.concatenate([x[k] for k in some]) for x in (run, us))
    order = np.lexsort((at, w, r))
    w, r, at = w[order], r[order], at[order]
    if not len(w):
        return
    first = np.flatnonzero(np.r_[True, (np.diff(w) != 0) | (np.diff(r) != 0)])
    lo, hi = at[first], at[np.r_[first[1:], len(at)] - 1]
    w, r = w[first], r[first]
    here = b[r] // SPAN == spans[r]
    before = np.r_[False, (np.diff(pairs) == 0) & (np.diff(spans) == 0) & (np.diff(b) == 1)][r]
    p = np.searchsorted(place, r * window_us + hi - b[r] * window_us, side="right") - start[r]
    prev = r[before] - 1
    q = np.searchsorted(place, prev * window_us + lo[before] - (b[prev] + 1) * window_us) - start[prev]
    r, w, p, hi, q = (np.concatenate(x) for x in ((r[here], prev), (w[here], w[before]), (p[here], np.zeros(len(prev), np.int64)), (hi[here], np.full(len(prev), NEVER)), (m[r[here]], q)))
    if not len(w):
        return
    order = np.lexsort((w, r, w % blocks))
    r, w, p, hi, q = (x[order] for x in (r, w, p, hi, q))
    first = np.flatnonzero(np.r_[True, (np.diff(w) != 0) | (np.diff(r) != 0)])
    r, w, p, hi, q = r[first], w[first], np.maximum.reduceat(p, first), np.maximum.reduceat(hi, first), np.minimum.reduceat(q, first)
    q = np.maximum(p, q)
    any_ = (p > 0) | (q < m[r])
    r, w, p, hi, q = (x[any_] for x in (r, w, p, hi, q))
    block = w % blocks
    cut = np.flatnonzero(np.diff(block)) + 1
    for i, j in zip([0, *cut], [*cut, len(w)]):
        for k in range(i, j, 65_536):
            s = slice(k, min(j, k + 65_536))
            x = r[s]
            lists = [pairs[x], b[x], w[s], p[s].astype("int32"), q[s].astype("int32"), hi[s], m[x].astype("int32"), last[x]]
            yield pa.RecordBatch.from_arrays([pa.array(block[k : k + 1].astype("int32")), *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(v)) for v in lists)], names=["block", *GAP])


class _Block:
    """Wallets by name, and their gaps by bucket, the latest first."""

    def __init__(self, gaps: list[str], names: list[str]) -> None:
        import numpy as np

        t = pa.Table.from_batches(read_blocks(names, None, 65_536)).sort_by("wallet")
        self.names = t["wallet"].combine_chunks()
        self.names = self.names.chunk(0) if isinstance(self.names, pa.ChunkedArray) else self.names
        self.bytes = np.array(self.names.to_pylist(), "S")
        hashes = t["w"].to_numpy()
        order = np.argsort(hashes)
        got = list(read_blocks(gaps, None, 64))
        pair, b, w, *rest = (np.concatenate([x[c].flatten().to_numpy() for x in got]) for c in GAP)
        of = order[np.searchsorted(hashes[order], w)]
        order = np.lexsort((of, pair, -b))
        pair, b, self.of, self.p, self.q, self.hi, self.m, self.last = (v[order] for v in (pair, b, of, *rest))
        self.start = np.flatnonzero(np.r_[True, (np.diff(pair) != 0) | (np.diff(b) != 0)])
        self.n = np.diff(np.r_[self.start, len(b)])
        self.key = -b[self.start], pair[self.start]


def _co_traded(batches: Iterator[pa.RecordBatch], gaps: dict[int, list[str]], names: dict[int, list[str]], window_us: int) -> Iterator[pa.RecordBatch]:
    """Couples of wallets of the couples of blocks numbered in ``batches``."""
    import numpy as np

    of, held = sorted(names), (None, None)
    for k in (int(k) for x in batches for k in x["id"].to_numpy()):
        i = 0
        while k >= len(of) - i:
            k, i = k - (len(of) - i), i + 1
        if held[0] != i:
            held = i, _Block(gaps[of[i]], names[of[i]])
        x = held[1]
        y = x if not k else _Block(gaps[of[i + k]], names[of[i + k]])
        later = np.arange(1, len(x.names) + 1) if not k else None
        for u, v, weight, latest in _coupled(x, y, window_us, not k):
            if later is None:
                later = np.searchsorted(y.bytes, x.bytes)
            for s in range(0, len(u), 65_536):
                s = slice(s, s + 65_536)
                ordered, both = v[s] >= later[u[s]], pa.concat_arrays([x.names, y.names])
                a, b = u[s], v[s] + len(x.names)
                src, dst = np.where(ordered, a, b), np.where(ordered, b, a)
                yield pa.RecordBatch.from_arrays([both.take(pa.array(src)), both.take(pa.array(dst)), pa.array(weight[s]), pa.array(latest[s])], names=["src", "dst", "weight", "latest"])


def _coupled(x: _Block, y: _Block, window_us: int, same: bool) -> Iterator[tuple]:
    """Places in ``x`` and ``y`` of the wallets that share trades, how many, and the time of the last."""
    import numpy as np

    b, pair = (np.concatenate(z) for z in zip(x.key, y.key))
    order = np.lexsort((pair, b))  # stable: that of x comes first
    met = np.flatnonzero((np.diff(b[order]) == 0) & (np.diff(pair[order]) == 0))
    kx, ky = order[met], order[met + 1] - len(x.n)
    cells = x.n[kx] * y.n[ky]
    if not len(cells):
        return
    shape = len(x.names), len(y.names)
    many = cells >= DENSE if cells.sum() * 8 >= shape[0] * shape[1] else np.zeros(len(cells), bool)
    sums = []
    # Buckets of few couples, expanded together.
    few, sx, sy = np.flatnonzero(~many), x.start[kx], y.start[ky]
    total = np.cumsum(cells[few])
    first = 0
    while first < len(few):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + PAIRS, side="right")))
        f = few[first:last]
        first = last
        n = cells[f]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(y.n[ky[f]], n)
        u, v = np.repeat(sx[f], n) + k // wide, np.repeat(sy[f], n) + k % wide
        if same:
            u, v = u[keep := x.of[u] < y.of[v]], v[keep]
        p1, q1, p2, q2, m = x.p[u], x.q[u], y.p[v], y.q[v], x.m[u]
        n = np.minimum(p1, p2) + (m - np.maximum(q1, q2)) + np.maximum(p1 - q2, 0) + np.maximum(p2 - q1, 0)
        cell, n, us = (z[n > 0] for z in (x.of[u] * shape[1] + y.of[v], n, _last(p1, q1, x.hi[u], p2, q2, y.hi[v], m, x.last[u])))
        sums.append(_summed(cell, n, us))
        if len(sums) > 1 and len(sums[-1][0]) * 2 > len(sums[0][0]):
            sums = [_summed(*(np.concatenate(z) for z in zip(*sums)))]
    cell, shared, us = _summed(*(np.concatenate(z) for z in zip(*sums))) if sums else (np.zeros(0, np.int64),) * 3
    if not many.any():
        yield cell // shape[1], cell % shape[1], shared, us
        return
    weight, latest = np.zeros(shape, np.int64), np.full(shape, NEVER)
    for k in np.flatnonzero(many):
        a, c = slice(sx[k], sx[k] + x.n[kx[k]]), slice(sy[k], sy[k] + y.n[ky[k]])
        i, j, p1, q1, h1, p2, q2, h2 = x.of[a], y.of[c], x.p[a], x.q[a], x.hi[a], y.p[c], y.q[c], y.hi[c]
        m, last = x.m[a.start], x.last[a.start]
        n = np.minimum(p1[:, None], p2)
        z = np.maximum(q1[:, None], q2)
        n += np.subtract(m, z, out=z)
        n += np.maximum(np.subtract(p1[:, None], q2, out=z), 0, out=z)
        n += np.maximum(np.subtract(p2, q1[:, None], out=z), 0, out=z)
        at = np.ix_(i, j)
        weight[at] += n
        # Buckets come latest first: what has a trade of a later one keeps it.
        seen = latest[at]
        u, v = np.nonzero((seen < last // window_us * window_us + window_us) & (n > 0))
        latest[i[u], j[v]] = np.maximum(seen[u, v], _last(p1[u], q1[u], h1[u], p2[v], q2[v], h2[v], m, last))
    weight.reshape(-1)[cell] += shared
    latest.reshape(-1)[cell] = np.maximum(latest.reshape(-1)[cell], us)
    for k in range(0, shape[0], 256):
        i, j = np.nonzero(np.triu(weight[k : k + 256], k + 1) if same else weight[k : k + 256])
        i += k
        yield i, j, weight[i, j], latest[i, j]


def _last(p1, q1, hi1, p2, q2, hi2, m, last):
    """Time of the last trade of a bucket outside both gaps, where there is one: the bucket's last, or one wallet's last activity that the other's cover holds."""
    import numpy as np

    us = np.minimum(hi1, hi2)
    us = np.where(p1 > q2, hi1, np.where(p2 > q1, hi2, us))
    return np.where(np.maximum(q1, q2) < m, last, us)


def _summed(cell, n, us) -> tuple:
    """One row a cell, in order: the sum and the latest."""
    import numpy as np

    if not len(cell):
        return cell, n.astype(np.int64), us
    order = np.argsort(cell, kind="stable")
    cell, n, us = cell[order], n[order], us[order]
    first = np.flatnonzero(np.r_[True, np.diff(cell) != 0])
    return cell[first], np.add.reduceat(n, first, dtype=np.int64), np.maximum.reduceat(us, first)


def coordination(trades: DataFrame, window_us: int) -> DataFrame:
    """Edges from the later to the earlier base account of trades on a pair and venue within the window."""
    a = trades.filter("base is not null").select("pair", "venue", "ts", "trade_id", F.col("base").alias("src"))
    b = a.select("pair", "venue", F.col("ts").alias("right_ts"), F.col("trade_id").alias("right_id"), F.col("src").alias("dst"))
    j = interval_join(a, b, ["pair", "venue"], window_us, 0)
    earlier = (F.col("right_ts") < F.col("ts")) | ((F.col("right_ts") == F.col("ts")) & (F.col("right_id") < F.col("trade_id")))
    return j.filter(earlier & (F.col("src") != F.col("dst"))).groupBy("venue", "src", "dst").agg(F.count("*").alias("weight"))


def amount_links(left: DataFrame, right: DataFrame, window_us: int, tolerance: float) -> DataFrame:
    """Wallets of both venues that moved nearly the same amount within the window: (wallet, other, n).

    Amounts are keyed by buckets of their logarithm as wide as the tolerance, looked up in three neighbours, so
    the join needs no comparison of all pairs.
    """
    width = F.log1p(F.lit(tolerance))
    key = lambda c: F.floor(F.log(c.cast("double")) / width).cast("bigint")
    a = left.filter("amount > 0").select("wallet", "ts", "amount", F.explode(F.array(*[key(F.col("amount")) + d for d in (-1, 0, 1)])).alias("k"))
    b = right.filter("amount > 0").select(F.col("wallet").alias("other"), F.col("ts").alias("right_ts"), F.col("amount").alias("right_amount"), key(F.col("amount")).alias("k"))
    j = interval_join(a, b, ["k"], window_us, window_us)
    near = F.abs(F.col("amount") - F.col("right_amount")).cast("double") <= F.greatest("amount", "right_amount").cast("double") * tolerance
    return j.filter(near & (F.col("wallet") != F.col("other"))).groupBy("wallet", "other").agg(F.count("*").alias("n"))


def as_of(left: DataFrame, right: DataFrame, key: str, value: str, ts: str = "ts", valid_us: int | None = None, block_us: int = DAY) -> DataFrame:
    """``left`` with the last ``value`` of ``right`` at or before each time; null if none, or older than ``valid_us``.

    A key's rows are ordered within blocks of time, so one key with most of the rows is the work of many tasks; the last
    value before a block is carried into it as a row at its begin. ``right`` has one row for a key and time; rows
    without either meet nothing. ``left`` is read twice.
    """
    names, kind = left.columns, right.schema[value].dataType
    block = F.coalesce(bucket(F.col(ts), block_us), F.lit(0))
    # Rows that can't match are spread, as they have no block.
    lone = F.col(key).isNull() | F.col(ts).isNull()
    l = left.select(F.col(key).alias("__k"), F.unix_micros(ts).alias("__t"), F.when(lone, F.xxhash64(F.monotonically_increasing_id()) % 65_536).otherwise(block).alias("__b"), F.struct(*names).alias("__row"), F.lit(None).cast(kind).alias("__v"), F.lit(None).cast("bigint").alias("__at"), F.lit(2).alias("__o"))
    r = right.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).alias("__k"), F.unix_micros(ts).alias("__t"), block.alias("__b"), F.lit(None).cast(left.select(F.struct(*names)).schema[0].dataType).alias("__row"), F.col(value).alias("__v"), F.unix_micros(ts).alias("__at"), F.lit(1).alias("__o"))
    last = r.groupBy("__k", "__b").agg(F.max_by(F.struct("__v", "__at"), "__t").alias("x"))
    wanted = left.filter(~lone).select(F.col(key).alias("__k"), block.alias("__b")).distinct().join(r.select("__k").distinct(), "__k", "left_semi").withColumn("x", F.lit(None).cast(last.schema["x"].dataType))
    steps = wanted.unionByName(last).groupBy("__k", "__b").agg(F.max_by("x", F.col("x").isNotNull()).alias("x"))
    before = F.last("x", ignorenulls=True).over(Window.partitionBy("__k").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    carried = steps.withColumn("p", before).filter("p is not null").select("__k", (F.col("__b") * block_us).alias("__t"), "__b", F.lit(None).cast(r.schema["__row"].dataType).alias("__row"), F.col("p.__v").alias("__v"), F.col("p.__at").alias("__at"), F.lit(0).alias("__o"))
    w = Window.partitionBy("__k", "__b").orderBy("__t", "__o")
    got = F.last(F.when(F.col("__o") < 2, F.struct("__v", "__at")), ignorenulls=True).over(w)
    out = l.unionByName(r).unionByName(carried).withColumn("__got", got).filter("__o = 2")
    fresh = F.lit(True) if valid_us is None else F.col("__t") - F.col("__got.__at") <= valid_us
    return out.select("__row.*", F.when(fresh, F.col("__got.__v")).alias(value))


def timing_correlation(a: DataFrame, b: DataFrame, seconds: int = 3600, least: int = 5, threshold: float = 0.8) -> DataFrame:
    """Wallets of two venues whose activity histograms correlate over all bins between the first and last trade, empty ones included: (wallet, other, n, r).

    Bins begin at the first trade; ``n`` counts those in which both were active. Zeros need no rows: the sums over shared
    bins and each wallet's own sums give r, and without a shared bin r is below 0. Wallets move as hashes and pairs not
    at all: histograms, one row a wallet, lie in the shared folder, and a task holds some of one venue and reads all of the other.
    """
    width = seconds * SECOND
    side = lambda df, right: df.filter("ts is not null").select(F.lit(right).alias("right"), "wallet", F.unix_micros("ts").alias("us"))
    both = side(a, False).unionByName(side(b, True))
    names, h = told_apart(both.groupBy("wallet").agg(F.min("us").alias("lo"), F.max("us").alias("hi")), "wallet")
    ends = names.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("lo", F.ceil((F.col("hi") - F.col("lo")) / width).cast("bigint").alias("bins")).filter(F.col("bins") >= least)
    # The last bin is closed.
    slot = F.least(F.floor((F.col("us") - F.col("lo")) / width).cast("bigint"), F.col("bins") - 1)
    c = both.crossJoin(F.broadcast(ends)).groupBy("right", h("wallet").alias("w"), "bins", slot.alias("bin")).agg(F.count("*").alias("c"))
    square = F.col("c") * F.col("c")
    per = c.groupBy("right", "w", "bins").agg(F.sum("c").alias("s"), F.sum(square).alias("q"), F.max("c").alias("m"), F.collect_list(F.struct("bin", "c")).alias("h"))
    per = per.withColumn("v", F.col("bins") * F.col("q") - F.col("s") * F.col("s")).filter("v > 0").select("right", "w", "bins", "s", "m", "v", "h.bin", "h.c")
    rows = written(per, "histograms")
    entries = rows.filter("not right").agg(F.sum(F.size("bin"))).head()[0] or 0
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-entries // ENTRIES))
    at = rows.inputFiles()
    found = rows.filter("not right").drop("right").repartition(tasks, "w").mapInArrow(lambda it: _correlated(it, at, threshold), "wx bigint, wy bigint, n bigint, r double")
    name = lambda w, n: names.select(h("wallet").alias(w), F.col("wallet").alias(n))
    return found.join(name("wx", "wallet"), "wx").join(name("wy", "other"), "wy").filter("wallet <> other").select("wallet", "other", "n", F.round("r", 4).alias("r"))


ENTRIES = 1 << 18  # wallets' bins that a task holds
PAIRS = 1 << 21  # entries compared at once


def _correlated(batches: Iterator[pa.RecordBatch], files: list[str], threshold: float) -> Iterator[pa.RecordBatch]:
    """Pairs of the wallets in ``batches`` with those of the other side in ``files``."""
    import numpy as np

    held = [x for x in batches if x.num_rows]
    if not held:
        return
    x = pa.Table.from_batches(held).combine_chunks()
    w, bins, s, m, v, bin_, c, k = _flat(x)
    ofx = np.repeat(np.arange(len(w)), k)
    order = np.argsort(bin_, kind="stable")
    bin_, c, ofx = bin_[order], c[order], ofx[order]
    lo = np.searchsorted(bin_, np.arange(bins[0] + 1))
    for y in read_blocks(files, ds.field("right"), 4096):
        wy, _, sy, my, vy, biny, cy, ky = _flat(y)
        ofy, meets = np.repeat(np.arange(len(wy)), ky), lo[biny + 1] - lo[biny]
        total = np.r_[0, np.cumsum(np.add.reduceat(np.r_[meets, 0], np.r_[0, np.cumsum(ky)[:-1]]))]  # a wallet has a bin at least
        begin, first = np.r_[0, np.cumsum(ky)], 0
        while first < len(wy):
            # Whole wallets, so that their sums are complete.
            last = max(first + 1, int(np.searchsorted(total, total[first] + PAIRS, side="right")) - 1)
            part = slice(begin[first], begin[last])
            first = last
            n = meets[part]
            j = np.repeat(np.arange(part.start, part.stop), n)
            i = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[biny[j]]
            a, b = ofx[i], ofy[j]
            most = bins[0] * np.minimum(m[a] * sy[b], my[b] * s[a]) - s[a] * sy[b]
            near = most >= (threshold - 1e-9) * np.sqrt(v[a].astype(float) * vy[b])
            i, j, a, b = i[near], j[near], a[near], b[near]
            pair, at, shared = np.unique(b * len(w) + a, return_inverse=True, return_counts=True)
            xy = np.zeros(len(pair), np.int64)
            np.add.at(xy, at, c[i] * cy[j])
            a, b = pair % len(w), pair // len(w)
            r = (bins[0] * xy - s[a] * sy[b]) / np.sqrt(v[a].astype(float) * vy[b])
            hit = r >= threshold
            yield pa.RecordBatch.from_arrays([pa.array(w[a[hit]]), pa.array(wy[b[hit]]), pa.array(shared[hit]), pa.array(r[hit])], names=["wx", "wy", "n", "r"])


def _flat(t: pa.Table | pa.RecordBatch) -> list:
    """Columns of histograms as arrays: one value a wallet, bins and counts end to end, and how many of these a wallet has."""
    one = [t[n].to_numpy() for n in ("w", "bins", "s", "m", "v")]
    lists = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (t["bin"], t["c"])]
    lists = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in lists]
    return [*one, *(x.flatten().to_numpy() for x in lists), lists[0].value_lengths().to_numpy().astype("int64")]
