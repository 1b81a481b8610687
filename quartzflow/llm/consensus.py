"""Consensus of several annotators' labels by expectation-maximisation over confusion matrices.

Items whose votes are the same are one pattern with a count, so an iteration reads the patterns, not the verdicts. Each
iteration is one narrow pass over the written patterns, and only (annotators x labels x labels) sums reach the driver.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartzflow.session import written

SMOOTHING = 1.0  # verdicts added to each row of a confusion matrix, spread as the pooled matrix is
MAX_ROUNDS = 100
TOLERANCE = 1e-7
MODEL_CELLS = 4_000_000  # most annotators x labels x labels: 32 MB


@dataclass(frozen=True)
class Consensus:
    items: DataFrame  # item, label, posterior, n_verdicts, agreement
    annotators: DataFrame  # annotator, true_label, given_label, share, n_verdicts, reliability
    rounds: int


def latest_verdicts(df: DataFrame, item: Column, annotator: Column, label: str, at: str, tie: str) -> DataFrame:
    """One verdict per item and annotator: the one with the latest ``at``, of equals the one with the largest ``tie``.

    Rows without item, annotator or label do not count. A null ``at`` is the earliest.
    """
    src = df.select(item.alias("item"), annotator.alias("annotator"), F.col(label).cast("string").alias("label"), F.unix_micros(F.col(at).cast("timestamp")).alias("at"), F.col(tie).alias("tie"))
    src = src.filter(F.col("item").isNotNull() & F.col("annotator").isNotNull() & F.col("label").isNotNull())
    order = F.struct(F.coalesce("at", F.lit(-(2**63))), F.col("tie"))
    return src.groupBy("item", "annotator").agg(F.max_by("label", order).alias("label"))


def vote_patterns(verdicts: DataFrame, annotators: dict[str, int], labels: dict[str, int]) -> DataFrame:
    """item and its sorted votes, each one number: annotator x labels + label. An item has at most one of an annotator."""
    spark = verdicts.sparkSession
    codes = spark.createDataFrame([(a, k) for a, k in annotators.items()], "annotator string, a int")
    label = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    coded = verdicts.join(F.broadcast(codes), "annotator").select("item", (F.col("a") * len(labels) + label[F.col("label")]).cast("int").alias("vote"))
    return coded.groupBy("item").agg(F.sort_array(F.collect_list("vote")).alias("votes"))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and vote of every vote of a list column."""
    sizes = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), sizes), column.flatten().to_numpy()


def _posterior(rows: np.ndarray, votes: np.ndarray, n: int, log_conf: np.ndarray, log_prior: np.ndarray) -> np.ndarray:
    k = len(log_prior)
    score = np.tile(log_prior, (n, 1))
    for t in range(k):
        score[:, t] += np.bincount(rows, weights=log_conf[votes // k, t, votes % k], minlength=n)
    score -= score.max(axis=1, keepdims=True)
    p = np.exp(score)
    return p / p.sum(axis=1, keepdims=True)


def _majority(rows: np.ndarray, votes: np.ndarray, n: int, k: int) -> np.ndarray:
    p = np.stack([np.bincount(rows, weights=votes % k == t, minlength=n) for t in range(k)], axis=1)
    return p / p.sum(axis=1, keepdims=True)


def consensus(verdicts: DataFrame, smoothing: float = SMOOTHING, max_rounds: int = MAX_ROUNDS) -> Consensus:
    """Consensus label per item of ``verdicts`` (item, annotator, label: one row per item and annotator).

    The label is the one with the highest posterior; of equals the first in order. Without verdicts both results are
    empty. Items with one verdict count like the others. Raises ValueError if the model would exceed MODEL_CELLS.
    """
    spark = verdicts.sparkSession
    verdicts = written(verdicts, "verdicts")
    n_annotators, k = verdicts.agg(F.count_distinct("annotator"), F.count_distinct("label")).head()
    if n_annotators * k * k > MODEL_CELLS:
        raise ValueError(f"{n_annotators} annotators and {k} labels exceed the model's bound of {MODEL_CELLS} cells")
    labels = {r[0]: j for j, r in enumerate(verdicts.select("label").distinct().orderBy("label").collect())}
    names = [r[0] for r in verdicts.select("annotator").distinct().orderBy("annotator").collect()]
    if not names:
        return Consensus(
            spark.createDataFrame([], "item string, label string, posterior double, n_verdicts bigint, agreement double"),
            spark.createDataFrame([], "annotator string, true_label string, given_label string, share double, n_verdicts bigint, reliability double"),
            0,
        )
    votes = written(vote_patterns(verdicts, {a: j for j, a in enumerate(names)}, labels), "votes")
    patterns = written(votes.groupBy("votes").agg(F.count("*").alias("n")), "patterns")

    def sums(model: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
        """Expected counts by annotator, true label and given label; the last row counts the items by true label."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((n_annotators * k + 1, k))
            for b in batches:
                if not b.num_rows:
                    continue
                rows, v = _flat(b.column("votes"))
                weight = b.column("n").to_numpy().astype(float)
                p = _majority(rows, v, b.num_rows, k) if model is None else _posterior(rows, v, b.num_rows, *model)
                p = p * weight[:, None]
                for t in range(k):
                    total[:-1, t] += np.bincount(v, weights=p[rows, t], minlength=n_annotators * k)
                total[-1] += p.sum(axis=0)
            at = np.nonzero(total)
            yield pa.RecordBatch.from_pydict({"i": pa.array(at[0], pa.int64()), "t": pa.array(at[1], pa.int32()), "s": pa.array(total[at])})

        out = np.zeros((n_annotators * k + 1, k))
        for r in patterns.mapInArrow(run, "i bigint, t int, s double").groupBy("i", "t").agg(F.sum("s").alias("s")).collect():
            out[r["i"], r["t"]] = r["s"]
        return out

    model, rounds = None, 0
    for rounds in range(1, max_rounds + 1):
        s = sums(model)
        counts = s[:-1].reshape(n_annotators, k, k).transpose(0, 2, 1)  # annotator, true, given
        pooled = counts.sum(axis=0) + 1e-9
        pooled /= pooled.sum(axis=1, keepdims=True)
        smooth = counts + smoothing * pooled
        conf = smooth / smooth.sum(axis=2, keepdims=True)
        prior = (s[-1] + smoothing / k) / (s[-1].sum() + smoothing)
        new = (np.log(np.maximum(conf, 1e-12)), np.log(prior))
        moved = np.inf if model is None else np.abs(np.exp(new[0]) - np.exp(model[0])).max()
        model = new
        if moved < TOLERANCE:
            break
    else:
        warnings.warn(f"the consensus still moved by {moved:.2g} after {max_rounds} rounds", stacklevel=2)

    by_code = list(labels)

    def label_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            rows, v = _flat(b.column("votes"))
            p = _posterior(rows, v, b.num_rows, *model)
            best = p.argmax(axis=1)
            m = np.bincount(rows, minlength=b.num_rows)
            same = np.stack([np.bincount(rows, weights=v % k == t, minlength=b.num_rows) for t in range(k)], axis=1)
            pairs = m * (m - 1)
            agree = np.divide((same * (same - 1)).sum(axis=1), pairs, out=np.zeros(len(m)), where=pairs > 0)
            yield pa.RecordBatch.from_pydict(
                {
                    "item": b.column("item"),
                    "label": pa.array([by_code[j] for j in best], pa.string()),
                    "posterior": pa.array(p[np.arange(len(best)), best]),
                    "n_verdicts": pa.array(m, pa.int64()),
                    "agreement": pa.array(agree, mask=pairs == 0),
                }
            )

    items = votes.mapInArrow(label_items, "item string, label string, posterior double, n_verdicts bigint, agreement double")
    conf = np.exp(model[0])
    given = counts.sum(axis=(1, 2))
    rows = [(names[a], by_code[t], by_code[g], float(conf[a, t, g]), int(round(given[a])), float(np.mean(np.diag(conf[a])))) for a in range(n_annotators) for t in range(k) for g in range(k)]
    annotators = spark.createDataFrame(rows, "annotator string, true_label string, given_label string, share double, n_verdicts bigint, reliability double")
    return Consensus(items, annotators, rounds)


def agreement(verdicts: DataFrame) -> DataFrame:
    """Chance-corrected agreement over all items with two verdicts or more, apart from any consensus.

    One row: n_items, n_verdicts, observed (share of agreeing pairs of verdicts, each item weighted by its verdicts),
    expected (of two verdicts drawn at random), alpha (Krippendorff, nominal; null if no disagreement is possible).
    """
    per_label = verdicts.groupBy("item", "label").agg(F.count("*").alias("c"))
    per_item = per_label.groupBy("item").agg(F.sum("c").alias("m"), F.sum(F.col("c") * (F.col("c") - 1)).alias("same")).filter("m > 1")
    total = per_item.agg(F.count("*").alias("n_items"), F.sum("m").alias("n"), F.sum(F.col("same") / (F.col("m") - 1)).alias("o"))
    # Expected pairs from the labels of the same items.
    margin = per_label.join(per_item.select("item"), "item").groupBy("label").agg(F.sum("c").alias("c")).agg(F.sum(F.col("c") * (F.col("c") - 1)).cast("double").alias("e"))
    r = total.crossJoin(margin)  # one row each
    observed, expected = F.try_divide(F.col("o"), F.col("n")), F.try_divide(F.col("e"), F.col("n") * (F.col("n") - 1))
    return r.select("n_items", F.coalesce("n", F.lit(0)).alias("n_verdicts"), observed.alias("observed"), expected.alias("expected"), F.try_divide(observed - expected, 1 - expected).alias("alpha"))
