"""Graphs as edge tables. Iterations write their state to the shared folder, so lineage stays short and survives lost executors."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quartzflow.session import read_blocks, told_apart, written


def undirected(edges: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b."""
    return edges.filter("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()


def ancestors(edges: DataFrame, depth: int = 4) -> DataFrame:
    """(node, ancestor, hops) over at most ``depth`` edges against their direction, the node itself left out; fewest hops."""
    e = written(edges.filter("src <> dst").select("src", "dst").distinct(), "edges")
    level = e.select(F.col("dst").alias("node"), F.col("src").alias("ancestor"), F.lit(1).alias("hops"))
    seen = level
    for k in range(2, depth + 1):
        step = level.join(e.withColumnsRenamed({"dst": "ancestor", "src": "up"}), "ancestor").select("node", F.col("up").alias("ancestor"), F.lit(k).alias("hops")).filter("node <> ancestor").distinct()
        level = written(step.join(seen, ["node", "ancestor"], "left_anti"), "level")
        seen = seen.unionByName(level)
    return seen


def funding_similarity(anc: DataFrame) -> DataFrame:
    """Largest Jaccard similarity of a node's ancestors with those of any other node.

    Only nodes that share an ancestor are compared, and nodes with equal ancestors are one class first: a funder of a
    third of all accounts then meets itself once, not once for every pair of its accounts.
    """
    sets = anc.groupBy("node").agg(F.sort_array(F.collect_set("ancestor")).alias("s"))  # at most depth x in-degree
    cls = written(sets.groupBy("s").agg(F.count("*").alias("members")).withColumn("c", F.xxhash64("s")), "classes")
    el = cls.select("c", F.size("s").alias("k"), F.explode("s").alias("x"))
    r = el.withColumnsRenamed({"c": "d", "k": "m"})
    both = el.join(r, "x").filter("c <> d").groupBy("c", "d", "k", "m").agg(F.count("*").alias("i"))
    best = both.groupBy("c").agg(F.max(F.col("i") / (F.col("k") + F.col("m") - F.col("i"))).alias("j"))
    per = cls.join(best, "c", "left").select("s", F.when(F.col("members") > 1, 1.0).otherwise(F.coalesce("j", F.lit(0.0))).alias("similarity"))
    return sets.join(per, "s").select("node", F.round("similarity", 6).alias("similarity"))


def degree_centrality(edges: DataFrame) -> DataFrame:
    """(in + out) / (n - 1) of every node; 0 in a graph of one node."""
    e = edges.select("src", "dst").distinct()
    deg = e.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    n = deg.agg(F.count("*").alias("n"))
    return deg.crossJoin(F.broadcast(n)).select("node", "degree", F.round(F.coalesce(F.try_divide("degree", F.col("n") - 1), F.lit(0.0)), 6).alias("centrality"))  # n is one row


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): connected components, named by their smallest node.

    Hash-to-min by alternating large and small star steps: rounds grow with the logarithm of the size.
    """
    e = written(undirected(edges), "edges")
    nodes = e.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    state = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
    before = None
    for _ in range(most_rounds):
        both = state.union(state.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").filter("u <> v").distinct()
        state = written(small, "stars")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components are not complete after {most_rounds} rounds")
    root = state.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(root, nodes.node == root.u, "left").select("node", F.coalesce("component", "node").alias("component"))


def communities(edges: DataFrame, rounds: int = 10, least: int = 3) -> DataFrame:
    """(node, community): label propagation, ties to the smallest label, for a fixed number of rounds; -1 in small communities.

    A node takes the label most frequent among its neighbours and itself, so the result is the same on every run.
    """
    e = written(undirected(edges), "edges")
    both = e.select("a", "b").union(e.select("b", "a"))
    label = both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node"))
    for _ in range(rounds):
        votes = both.join(label.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label").unionByName(label)
        count = votes.groupBy("node", "label").agg(F.count("*").alias("n"))
        best = count.groupBy("node").agg(F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("x"))
        label = written(best.select("node", F.col("x.label").alias("label")), "labels")
    sizes = label.groupBy("label").agg(F.count("*").alias("size"))
    return label.join(sizes, "label").select("node", F.when(F.col("size") >= least, F.col("label")).otherwise(F.lit("-1")).alias("community"))


def ring_statistics(member: DataFrame, edges: DataFrame) -> DataFrame:
    """Size, density of inner edges and a stable name of each community of ``member`` (node, community)."""
    m = member.filter("community <> '-1'")
    e = undirected(edges)
    inner = e.join(m.select(F.col("node").alias("a"), F.col("community").alias("ca")), "a").join(m.select(F.col("node").alias("b"), F.col("community").alias("cb")), "b").filter("ca = cb").groupBy(F.col("ca").alias("community")).agg(F.count("*").alias("k"))
    # The name needs every member of a ring in one row: only the hashes of the members are added up.
    size = m.groupBy("community").agg(F.count("*").alias("size"), F.sum(F.conv(F.substring(F.sha1("node"), 1, 12), 16, 10).cast("decimal(38,0)")).alias("h"))
    d = F.col("k") / (F.col("size") * (F.col("size") - 1) / 2)
    return size.join(inner, "community", "left").select("community", "size", F.round(F.coalesce(d, F.lit(0.0)), 6).alias("density"), F.substring(F.sha1(F.col("h").cast("string")), 1, 12).alias("ring_id"))


def motifs(edges: DataFrame) -> DataFrame:
    """Triangles, wedges, four-cycles of the undirected graph and reciprocity of the directed one, in one row.

    Nodes are hashes, then numbers in the order of their degrees. A two-step path is looked at only from its highest
    node, which bounds the paths at hubs: those to a lower end by lower middles. Two of them between the same ends are a
    four-cycle, one whose ends are joined is half a triangle. They are counted in tasks that have the neighbours of some
    highest nodes and read all neighbours from the shared folder, so no path is moved.
    """
    ends = edges.filter("src <> dst")
    _, h = told_apart(ends.select(F.explode(F.array("src", "dst")).alias("node")).distinct(), "node")
    d = written(ends.select(h("src").alias("src"), h("dst").alias("dst")).distinct(), "edges")
    rec = d.join(d.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(1).alias("r")), ["src", "dst"], "left").agg(F.round(F.coalesce(F.avg(F.coalesce("r", F.lit(0))), F.lit(0.0)), 6).alias("reciprocity"))
    e = undirected(d)
    deg = e.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("d"))
    # Over sorted rows these ids rise with the order; less the gaps between partitions they are numbers without gaps.
    deg = written(deg.orderBy("d", "node").withColumn("id", F.monotonically_increasing_id()).withColumn("part", F.shiftright("id", 33)), "degrees")
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    gaps = deg.groupBy("part").agg(F.count("*").alias("size")).select("part", (F.coalesce(before, F.lit(0)) - F.shiftleft("part", 33)).alias("gap"))
    deg = deg.join(F.broadcast(gaps), "part").select("node", "d", (F.col("id") + F.col("gap")).alias("r"))  # gaps: a row a partition
    wedges = deg.agg(F.sum(F.col("d") * (F.col("d") - 1) / 2).cast("bigint").alias("wedges"))
    j = e.join(deg.select(F.col("node").alias("a"), F.col("r").alias("x")), "a").join(deg.select(F.col("node").alias("b"), F.col("r").alias("y")), "b").select("x", "y")
    both = j.union(j.select("y", "x"))
    near = written(both.groupBy("x").agg(F.sort_array(F.collect_list("y")).alias("n")), "neighbours")
    nodes, entries = near.agg(F.count("*"), F.coalesce(F.sum(F.size("n")), F.lit(0))).head()
    at, tasks = near.inputFiles(), max(near.sparkSession.sparkContext.defaultParallelism, -(-entries // NEIGHBOURS))
    counted = near.repartition(tasks, "x").mapInArrow(lambda it: _paths(it, at, nodes), "triangles bigint, four_cycles bigint")
    found = counted.agg((F.coalesce(F.sum("triangles"), F.lit(0)) / 2).cast("bigint").alias("triangles"), F.coalesce(F.sum("four_cycles"), F.lit(0)).alias("four_cycles"))
    return found.crossJoin(wedges).crossJoin(rec).select("triangles", "wedges", "four_cycles", "reciprocity")  # one row each


NEIGHBOURS = 1 << 17  # that a task holds
PATHS = 1 << 21  # looked at once


def _paths(batches: Iterator[pa.RecordBatch], files: list[str], nodes: int) -> Iterator[pa.RecordBatch]:
    """Twice the triangles, and the four-cycles, whose highest node is in ``batches``."""
    import numpy as np

    held = [t for t in batches if t.num_rows]
    if not held:
        return
    x = np.concatenate([t["x"].to_numpy() for t in held])
    of = np.repeat(np.arange(len(x)), np.concatenate([t["n"].value_lengths().to_numpy() for t in held]))
    m = np.concatenate([t["n"].flatten().to_numpy() for t in held])
    low = m < x[of]
    of, m = of[low], m[low]
    joined = np.sort(of * nodes + m)
    order = np.argsort(m, kind="stable")
    of, m = of[order], m[order]
    cells, counts, new, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def summed():
        key, n = np.unique(np.concatenate(new), return_counts=True) if new else (cells[:0], counts[:0])
        key, n = np.concatenate([cells, key]), np.concatenate([counts, n])
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        return key[first], np.add.reduceat(n, first) if len(first) else n

    for block in read_blocks(files, None, 32_768):
        ids, z, k = block["x"].to_numpy(), block["n"].flatten().to_numpy(), block["n"].value_lengths().to_numpy().astype("int64")
        begin = np.cumsum(k) - k
        rank = np.argsort(ids)
        row = np.minimum(np.searchsorted(ids, m, sorter=rank), len(ids) - 1)
        there = np.flatnonzero(ids[rank[row]] == m)
        row, top = rank[row[there]], of[there]
        # Neighbours are sorted: those below the highest node come first.
        n = np.searchsorted(np.repeat(np.arange(len(ids)), k) * nodes + z, row * nodes + x[top]) - begin[row]
        total, first = np.r_[0, np.cumsum(n)], 0
        while first < len(n):
            last = max(first + 1, int(np.searchsorted(total, total[first] + PATHS, side="right")) - 1)
            c = n[first:last]
            at = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) + np.repeat(begin[row[first:last]], c)
            new.append(np.repeat(top[first:last], c) * nodes + z[at])
            size, first = size + len(at), last
            if size > PATHS:
                cells, counts = summed()
                new, size = [], 0
    cells, counts = summed()
    side = joined[np.minimum(np.searchsorted(joined, cells), len(joined) - 1)] == cells if len(joined) else cells < 0
    yield pa.RecordBatch.from_arrays([pa.array([int(counts[side].sum())]), pa.array([int((counts * (counts - 1) // 2).sum())])], names=["triangles", "four_cycles"])


def propagate_risk(seeds: DataFrame, edges: DataFrame, alpha: float = 0.15, rounds: int = 50, tolerance: float = 1e-6) -> DataFrame:
    """Personalised PageRank of the seeds (node, score 0 to 100): (node, risk 0 to 100).

    Being linear, one iteration with the seeds' sum equals the sum over seeds. Mass at nodes without an outgoing
    edge is lost, as there is nowhere to send it. Ends when a round moves less than ``tolerance`` in all, or after
    ``rounds``.
    """
    e = edges.filter("src <> dst").select("src", "dst").distinct()
    out = e.groupBy("src").agg(F.count("*").alias("k"))
    w = written(e.join(out, "src").select("src", "dst", (1 / F.col("k")).alias("w")), "weights")
    start = seeds.select("node", (F.col("score") / 100).alias("s"))
    x = start.select("node", F.col("s").alias("x"))
    for _ in range(rounds):
        flow = w.join(x, w.src == x.node).groupBy("dst").agg(F.sum(F.col("x") * F.col("w")).alias("f"))
        last, x = x, written(start.join(flow, start.node == flow.dst, "full").select(F.coalesce("node", "dst").alias("node"), (alpha * F.coalesce("s", F.lit(0.0)) + (1 - alpha) * F.coalesce("f", F.lit(0.0))).alias("x")), "risk")
        old = last.withColumnRenamed("x", "y")
        if (x.join(old, "node", "full").agg(F.sum(F.abs(F.coalesce("x", F.lit(0.0)) - F.coalesce("y", F.lit(0.0))))).head()[0] or 0.0) < tolerance:
            break
    return x.select("node", F.round(F.least(F.lit(100.0), F.col("x") * 100), 6).alias("risk"))
