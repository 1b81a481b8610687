"""Queries of the problems 5 to 8 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzflow.functions.ids import account_id, annotator_id
from quartzflow.llm import consensus, leakage, packing, pii
from quartzflow.session import table

# ---- 5: consensus ---------------------------------------------------------------------------------------------------


def _verdicts(spark: SparkSession, sf: str) -> DataFrame:
    return consensus.latest_verdicts(table(spark, sf, "annotation_queue"), account_id("wallet"), annotator_id("annotator_id"), "label", "annotated_at", "annotation_id")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return consensus.consensus(_verdicts(spark, sf)).items.filter("label = '1'").select(F.col("item").alias("wallet"))


def p5_consensus(spark: SparkSession, sf: str) -> DataFrame:
    """Label, its posterior and the share of agreeing pairs of verdicts of every wallet."""
    return consensus.consensus(_verdicts(spark, sf)).items.withColumnRenamed("item", "wallet").withColumn("posterior", F.round("posterior", 6))


def p5_annotators(spark: SparkSession, sf: str) -> DataFrame:
    """Confusion matrix and reliability of every annotator."""
    return consensus.consensus(_verdicts(spark, sf)).annotators.withColumnRenamed("annotator", "annotator_id")


def p5_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Chance-corrected agreement over all wallets."""
    return consensus.agreement(_verdicts(spark, sf)).select("n_items", "n_verdicts", *[F.round(c, 9).alias(c) for c in ("observed", "expected", "alpha")])


# ---- 6: packing -----------------------------------------------------------------------------------------------------

KINDS_AT_MOST = 1_000


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    kinds = [(r["container"], r["capacity_tokens"]) for r in table(spark, sf, "containers").take(KINDS_AT_MOST + 1)]
    if len(kinds) > KINDS_AT_MOST:
        raise ValueError(f"more than {KINDS_AT_MOST} kinds of container")
    # Every byte is a token of the byte-level tokenizer, and one ends the text.
    return packing.pack(table(spark, sf, "documents"), "doc_id", F.octet_length("text") + 1, kinds)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf).filter("parts > 1 and part = 0").select("container", "doc_id")


def p6_contents(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf)


def p6_packed(spark: SparkSession, sf: str) -> DataFrame:
    """Invariants of the packing: documents and tokens packed, texts split that fit, containers that hold too much."""
    k = table(spark, sf, "containers")
    p = _packed(spark, sf).join(F.broadcast(k), "container")  # a row a kind, KINDS_AT_MOST
    docs = p.groupBy("container", "doc_id", "capacity_tokens").agg(F.sum("size").alias("size"), F.max("parts").alias("parts"))
    per = docs.groupBy("container").agg(F.count("*").alias("n_docs"), F.sum("size").alias("tokens"), F.count_if((F.col("parts") > 1) & (F.col("size") <= F.col("capacity_tokens"))).alias("n_split_wrongly"))
    over = p.groupBy("container", "bin", "capacity_tokens").agg(F.sum("size").alias("used")).groupBy("container").agg(F.count_if(F.col("used") > F.col("capacity_tokens")).alias("n_overfull"))
    return per.join(over, "container")


def p6_fill(spark: SparkSession, sf: str) -> DataFrame:
    """How full the containers are."""
    return packing.fill_report(_packed(spark, sf), table(spark, sf, "containers"))


# ---- 7: leaked test items -------------------------------------------------------------------------------------------


def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_spans(table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "eval_items"), "item_id", "text")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id")).distinct()


def p7_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Where the leaked words stand, to be removed."""
    return _leaks(spark, sf).withColumnsRenamed({"doc": "doc_id", "item": "item_id"})


# ---- 8: personal information ----------------------------------------------------------------------------------------


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return pii.personal_information(table(spark, sf, "documents"), "doc_id", "text")


def p8_redacted(spark: SparkSession, sf: str) -> DataFrame:
    """The texts with typed placeholders."""
    return pii.redacted(table(spark, sf, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p5_found, p5_consensus, p5_annotators, p5_agreement, p6_found, p6_contents, p6_packed, p6_fill, p7_found, p7_spans, p8_found, p8_redacted)}

SQL = {
    "p5_agreement": (
        "with v as (select upper(trim(wallet, ' ' || chr(9))) as item, lower(trim(annotator_id, ' ' || chr(9))) as a, arg_max(label, (coalesce(annotated_at, timestamptz '1900-01-01'), annotation_id)) as label from annotation_queue"
        " where label is not null and coalesce(trim(wallet, ' ' || chr(9)), '') <> '' and coalesce(trim(annotator_id, ' ' || chr(9)), '') <> '' group by 1, 2),"
        " c as (select item, label, count(*) as c from v group by 1, 2), i as (select item, sum(c) as m, sum(c * (c - 1)) as same from c group by 1 having sum(c) > 1),"
        " t as (select count(*) as n_items, sum(m) as n, sum(same / (m - 1)) as o from i), e as (select sum(s * (s - 1)) as e from (select label, sum(c) as s from c where item in (select item from i) group by 1))"
        " select n_items, cast(n as bigint) as n_verdicts, round(o / n, 9) as observed, round(e / (n * (n - 1)), 9) as expected, round((o / n - e / (n * (n - 1))) / (1 - e / (n * (n - 1))), 9) as alpha from t, e"
    ),
    "p6_packed": "select container, count(*) as n_docs, cast(sum(strlen(text) + 1) as bigint) as tokens, cast(0 as bigint) as n_split_wrongly, cast(0 as bigint) as n_overfull from documents, containers where text is not null and capacity_tokens >= 1 group by 1",
    "p6_found": "select container, doc_id from documents, containers where strlen(text) + 1 > capacity_tokens",
}
