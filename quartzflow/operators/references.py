"""References to records that do not exist (any more, or yet) at the time of the referring row.

A Bloom filter of the parent keys is built by an aggregation, packed into arrays of 64 blocks of 256 bits, and
broadcast; its size has a fixed bound, beyond which it only lets more references through. A reference that misses it is
an orphan for certain. Only what passes is joined with the exact times of existence: one row a key, so the join is
linear; keys that come and go very often are searched by time in a second step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quartzflow.operators.joins import as_of
from quartzflow.session import written

WORDS = 4  # of 64 bits in a block
GROUP = 64  # blocks in a row of the filter
BITS_PER_KEY = 16
FILTER_MB = 64  # most that is broadcast; with more than 33 million keys there are fewer bits a key
INLINE_SPANS = 16  # a key with more spans of existence is searched by time
NEVER = "9999-12-31 23:59:59"


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(blocks))


def _masks(key: Column, bits_a_word: int) -> list[Column]:
    """One or two bits in each word of a block, taken from two hashes."""
    h, g = F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2))
    one = F.lit(1).cast("bigint")
    bit = lambda x, k: F.call_function("shiftleft", one, F.shiftrightunsigned(x, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
    return [bit(h, k).bitwiseOR(bit(g, k)) if bits_a_word == 2 else bit(h, k) for k in range(WORDS)]


def filter_blocks(n_keys: int) -> tuple[int, int]:
    """Blocks of the filter for so many keys, and bits set in each word: fewer where the bound leaves under 8 bits a key."""
    most = max(1, FILTER_MB * 2**20 // (WORDS * 8 + 2))  # a row's array and overhead, spread over its blocks
    blocks = min(max(1, n_keys * BITS_PER_KEY // (64 * WORDS)), most)
    return blocks, 2 if blocks * 64 * WORDS >= 8 * n_keys else 1


def bloom_rows(keys: DataFrame, key: str, blocks: int, bits_a_word: int) -> DataFrame:
    """(__g, __words): the filter, GROUP blocks a row."""
    cols = [_block(F.col(key), blocks).alias("b"), *[m.alias(f"m{k}") for k, m in enumerate(_masks(F.col(key), bits_a_word))]]
    per = keys.select(*cols).groupBy("b").agg(*[F.bit_or(f"m{k}").alias(f"w{k}") for k in range(WORDS)])
    words = F.array(*[f"w{k}" for k in range(WORDS)])
    rows = per.groupBy(F.floor(F.col("b") / GROUP).cast("bigint").alias("__g")).agg(F.map_from_entries(F.collect_list(F.struct((F.col("b") % GROUP).cast("int"), words))).alias("m"))  # at most GROUP
    none = F.array(*[F.lit(0).cast("bigint")] * WORDS)
    return rows.select("__g", F.flatten(F.transform(F.sequence(F.lit(0), F.lit(GROUP - 1)), lambda i: F.coalesce(F.try_element_at("m", i), none))).alias("__words"))


def maybe_present(refs: DataFrame, key: str, rows: DataFrame, blocks: int, bits_a_word: int) -> DataFrame:
    """``refs`` with a column __maybe: false where the key is certainly not among the parents."""
    block = _block(F.col(key), blocks)
    joined = refs.join(F.broadcast(rows), F.floor(block / GROUP).cast("bigint") == F.col("__g"), "left")  # at most FILTER_MB
    at = (block % GROUP).cast("int") * WORDS
    hit = F.lit(True)
    for k, m in enumerate(_masks(F.col(key), bits_a_word)):
        hit = hit & (F.get("__words", at + k).bitwiseAND(m) == m)
    return joined.withColumn("__maybe", F.coalesce(hit, F.lit(False))).drop("__g", "__words")


def lifetimes(parents: DataFrame, changes: DataFrame) -> DataFrame:
    """Spans (key, since, until) during which a key exists; until is exclusive and null while it lasts.

    ``parents``: key, created (null: never). ``changes``: key, at, seq, removed. A key exists from the earliest
    ``created`` on, save while its last change is a removal; of changes at the same time the one with the largest
    seq counts. Changes of a key are ordered within a day; only one row per key and day is ordered across days, so a
    key with very many changes isn't one task's work.
    """
    born = parents.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min("created").alias("born")).filter(F.col("born").isNotNull())
    at = (
        changes.filter(F.col("key").isNotNull() & F.col("at").isNotNull())
        .groupBy("key", "at")
        .agg(F.max_by("removed", F.coalesce(F.col("seq"), F.lit(""))).alias("removed"))
        .withColumn("day", F.to_date("at"))
    )
    in_day = at.withColumn("next_at", F.lead("at").over(Window.partitionBy("key", "day").orderBy("at")))
    days = at.groupBy("key", "day").agg(F.min("at").alias("first_at"))
    over = Window.partitionBy("key").orderBy("day")
    days = days.select("key", "day", F.lead("first_at").over(over).alias("later_at"), F.when(F.lag("day").over(over).isNull(), F.col("first_at")).alias("very_first"))
    spans = in_day.join(days, ["key", "day"]).select("key", "at", F.coalesce("next_at", "later_at").alias("until"), "removed", (F.col("at") == F.col("very_first")).alias("is_first"))
    alive = spans.filter(~F.col("removed")).select("key", F.col("at").alias("since"), "until")
    before = spans.filter("is_first").select("key", F.col("at").alias("until"))
    # From birth to the first change; all of time for a key that never changes.
    base = born.join(before, "key", "left").select("key", F.col("born").alias("since"), "until")
    later = alive.join(born, "key").select("key", F.greatest("since", "born").alias("since"), "until")
    return base.unionByName(later).filter(F.col("until").isNull() | (F.col("since") < F.col("until")))


def orphans(refs: DataFrame, key: str, time: str, spans: DataFrame) -> DataFrame:
    """Rows of ``refs`` whose key doesn't exist at ``time`` by ``spans`` (see lifetimes).

    Null and empty keys must have been made null; they are no references and never come out. A null time is judged at
    the end of all time. Columns of ``refs`` stay as they are; repeated references come out repeatedly. With empty
    ``spans`` every reference is an orphan.

    ``refs`` is evaluated once. Spark broadcasts the keys' states if their file is under its threshold, else both sides
    are shuffled and AQE splits a key with very many references; what misses the filter has a join key of its own, so
    it neither meets anything nor gathers in one task.
    """
    names = refs.columns
    spans = written(spans, "lifetimes")
    many = spans.groupBy("key").agg(F.count("*").alias("n"))
    few = spans.join(many.filter(F.col("n") <= INLINE_SPANS), "key").groupBy("key").agg(F.collect_list(F.struct("since", "until")).alias("__spans"))  # at most INLINE_SPANS
    busy = written(many.filter(F.col("n") > INLINE_SPANS).select("key"), "busy")
    states = written(few.unionByName(busy.withColumn("__spans", F.lit(None).cast(few.schema["__spans"].dataType))), "states").withColumnRenamed("key", "__key")
    blocks, bits = filter_blocks(states.count())  # from the footers
    seen = maybe_present(refs.filter(F.col(key).isNotNull()), key, bloom_rows(states, "__key", blocks, bits), blocks, bits)
    own = F.concat(F.lit("\0"), F.xxhash64(*[F.col(c) for c in _hashable(refs)]).cast("string"))
    t = F.coalesce(F.col(time), F.lit(NEVER).cast("timestamp"))
    joined = seen.withColumn("__on", F.when(F.col("__maybe"), F.col(key)).otherwise(own)).join(states, F.col("__on") == F.col("__key"), "left")
    alive = F.exists("__spans", lambda x: (x["since"] <= t) & (x["until"].isNull() | (t < x["until"])))
    left = joined.withColumn("__open", F.col("__key").isNotNull() & F.col("__spans").isNull()).filter(F.col("__open") | ~F.coalesce(alive, F.lit(False))).select(*names, "__open")
    if busy.isEmpty():
        return left.select(*names)
    left = written(left, "undecided")
    at = "__at"
    found = as_of(left.filter("__open").withColumn(at, t), spans.join(busy, "key", "left_semi").select(F.col("key").alias(key), F.col("since").alias(at), F.struct("until").alias("__got")), key, "__got", ts=at)
    gone = found.filter(F.col("__got").isNull() | (F.col(at) >= F.col("__got.until")))
    return left.filter("not __open").select(*names).unionByName(gone.select(*names))


def _hashable(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]


def orphan_report(found: DataFrame, by: list[str], time: str) -> DataFrame:
    """Orphans per ``by`` and month: references, distinct keys."""
    return found.groupBy(*by, F.date_format(time, "yyyy-MM").alias("month")).agg(F.count("*").alias("n_orphans"), F.count_distinct("ref").alias("n_missing"))
