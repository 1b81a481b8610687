"""Evaluation of scores, selection of items, combination of models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def threshold_sweep(scored: DataFrame, grid: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and rates of ``scored`` (label 0 or 1, score) at every threshold.

    One aggregation by the highest threshold each score reaches; the rest accumulates over the grid.
    """
    g = sorted(grid)
    reached = F.size(F.filter(F.array(*[F.lit(float(t)) for t in g]), lambda t: t <= F.col("score").cast("double")))
    c = scored.filter("label is not null and score is not null").groupBy(*by, reached.alias("k")).agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    total = c.groupBy(*by).agg(F.sum("p").alias("all_p"), F.sum("n").alias("all_n"))
    steps = total.select(*by, "all_p", "all_n", F.posexplode(F.array(*[F.lit(float(t)) for t in g])).alias("k", "threshold")).withColumn("k", F.col("k") + 1)
    w = Window.partitionBy(*by).orderBy(F.desc("k"))
    at = steps.join(c, [*by, "k"], "left").select(*by, "threshold", "all_p", "all_n", F.sum(F.coalesce("p", F.lit(0))).over(w).alias("tp"), F.sum(F.coalesce("n", F.lit(0))).over(w).alias("fp"))
    precision, recall = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0)), F.coalesce(F.try_divide("tp", "all_p"), F.lit(0.0))
    return at.select(
        *by,
        "threshold",
        "tp",
        "fp",
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(F.coalesce(F.try_divide(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("all_p")), F.lit(0.0)), 6).alias("f1"),
        F.round(F.coalesce(F.try_divide("fp", "all_n"), F.lit(0.0)), 6).alias("fpr"),
    )


def best_threshold(sweep: DataFrame, floor: float = 0.0) -> DataFrame:
    """The threshold of the best F1 with recall of at least ``floor``, the lowest of equals."""
    return sweep.filter(F.col("recall") >= floor).orderBy(F.desc("f1"), "threshold").limit(1)


def auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by rank sums; ties count half. Scores are counted first, so the ordering is over distinct scores."""
    c = scored.filter("label is not null and score is not null").groupBy(*by, "score").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    w = Window.partitionBy(*by).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    x = c.withColumn("below", F.coalesce(F.sum("n").over(w), F.lit(0)))
    return x.groupBy(*by).agg(F.sum("p").alias("P"), F.sum("n").alias("N"), F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)).alias("u")).select(*by, "P", "N", F.round(F.try_divide("u", F.col("P") * F.col("N")), 6).alias("auc"))


def confusion(scored: DataFrame, by: str, threshold: float) -> DataFrame:
    s, y = F.col("score") >= threshold, F.col("label") == 1
    return scored.filter("label is not null and score is not null").groupBy(by).agg(F.count_if(s & y).alias("tp"), F.count_if(s & ~y).alias("fp"), F.count_if(~s & y).alias("fn"), F.count_if(~s & ~y).alias("tn"))


def latest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key, by aggregation: a key with most of the rows collapses map-side."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, "r.*")


def keyset_page(df: DataFrame, key: str, before: int, size: int) -> DataFrame:
    """The page of rows with a key below ``before``, newest first, and one more to tell whether others follow."""
    return df.filter(F.col(key) < before).orderBy(F.desc(key)).limit(size + 1)


def most_uncertain(df: DataFrame, k: int, tie: str) -> DataFrame:
    """The k rows whose score (0 to 100) is nearest to the middle: a top-k report."""
    return df.filter("score is not null").withColumn("margin", F.abs(F.col("score") - 50)).orderBy("margin", tie).limit(k)


def cosine(a: Column, b: Sequence[float]) -> Column:
    vec = F.array(*[F.lit(float(x)) for x in b])
    dot = F.aggregate(F.zip_with(a, vec, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))
    return F.coalesce(F.try_divide(dot, norm * sum(x * x for x in b) ** 0.5), F.lit(0.0))


def ensemble(df: DataFrame, models: Sequence[str], within: float = 10.0) -> DataFrame:
    """Median of three model scores (0 to 1) as 0 to 100; without two models within ``within`` points: 100, confidence 0."""
    x = F.sort_array(F.array(*[F.col(m) * 100 for m in models]))
    agree = F.least(x[1] - x[0], x[2] - x[1]) <= within
    return df.select("*", F.when(agree, F.round(x[1])).otherwise(100).cast("int").alias("score"), F.when(agree, F.round(F.abs(x[1] / 100 - 0.5) * 200)).otherwise(0).cast("int").alias("confidence"), agree.alias("consensus"))


def mid_rank_percentile(df: DataFrame, by: str, score: str, least: int = 50) -> DataFrame:
    """Mid-rank percentile of each distinct score of a group with ``least`` distinct scores or more."""
    d = df.filter(F.col(score).isNotNull()).select(by, score).distinct()
    n = d.groupBy(by).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    w = Window.partitionBy(by).orderBy(score)
    return d.join(n, by).select(by, score, F.round((F.row_number().over(w) - 0.5) / F.col("n") * 100, 4).alias("percentile"))


def conformal_quantile(calibrated: DataFrame, alpha: float) -> DataFrame:
    """Quantile of 1 - p(true label) that covers 1 - alpha of the calibration rows."""
    nc = F.when(F.col("label") == 1, 1 - F.col("p")).otherwise(F.col("p"))
    return calibrated.filter("label is not null and p is not null").agg(F.count("*").alias("n"), F.round(F.percentile(nc, 1 - alpha), 6).alias("q"))
