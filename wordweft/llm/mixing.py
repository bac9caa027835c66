"""Mix sources to target weights by weighted fair queueing.

A source queues its documents in hashed order, the whole queue up to three times over. Each queued
document gets a virtual finish time: the tokens its source has queued up to and including it, divided by
the source's target. The mix is the queue of all sources in order of finish time, cut where it would pass
the total budget; the document that would pass it, and all after it, are left out.

Targets: the sources share the budget by weight; a target stops at ``max_repeat`` times its source's
size, and the excess goes to the others by weight until none is above (solved in closed form over the
sources sorted by size per weight).

Scale: no window spans a source or the mix. A source's queue is summed over hash buckets (leading digits
of the digest, balanced whatever the source's share), then inside a bucket. The mix is summed over ranges
of finish time. Only tables of one row per source are handled by one task, and the two tables of bucket
sums hold at most one row per source and bucket.

Nulls: a null text has size 0, a null source is a source of its own and comes last. Documents of size 0
take nothing. Repeated rows queue each for itself. A source without words has target 0. An empty table
gives no rows. Extra columns are ignored by ``mix`` and returned by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_hex
from .common import keep, with_fresh

#: Fixed by the contract: the repeating weights, the most a document may repeat, and what a word is.
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
WORD = r"[^\x20\x09-\x0D]+"
SEED = 11
#: Hex digits that name a bucket of a source's queue, and finish-time cells per unit of virtual time.
DIGITS, CELLS = 3, 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size -> the same with its weight and target; one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(max_repeat))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every).cast("double")
    # Water level: the sources before this one are full, the rest share what is left.
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    ranked = (
        sources.withColumn("weight", weight).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("level", level)
    )
    open_level = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "source", "level"))).over(every)["level"]
    return (
        ranked.withColumn("open", open_level)
        .withColumn("target", F.when(F.col("open").isNull() | (F.col("ratio") <= F.col("open")), F.col("cap"))
                    .otherwise(F.col("weight") * F.col("open")))
        .select("source", "source_size", "weight", "target")
    )


def _running(rows: DataFrame, group: list[str], bucket: str, order: list, value: str, out: str) -> DataFrame:
    """Inclusive running sum of ``value`` in (bucket, order) within the group: bucket totals are scanned
    on their own, so a window over rows never leaves one bucket."""
    sums = rows.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    scan = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*group, bucket, F.coalesce(F.sum("_sum").over(scan), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("_in", F.sum(value).over(inside)).join(starts, [*group, bucket])
        .withColumn(out, F.col("_start") + F.col("_in")).drop("_start", "_in")
    )


def _cell(finish: Column) -> Column:
    """Order-preserving cell of a finish time: CELLS per unit up to 2, CELLS per doubling beyond."""
    far = F.lit(2.0) + F.log2(F.greatest(finish, F.lit(2.0)) / 2)
    return F.floor(F.when(finish < 2, finish).otherwise(far) * CELLS)


def _numbered(rows: DataFrame, key: str, out: str, *more: str) -> DataFrame:
    """Number the rows that share a document key; equal rows are told apart, whatever their order."""
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(key).orderBy("doc_id", *more)) - 1)


def document_key(size: Column) -> Column:
    """64-bit key of a document row: id, source, size and text."""
    return F.xxhash64(F.col("doc_id").cast("string"), F.lit("|"), F.col("source").cast("string"), size, F.col("text"))


def queue(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed=SEED) -> DataFrame:
    """doc_id, source, key, copy, size, source_id, source_size, target, digest, queued: one row per document row.

    ``queued`` is the running size of the source in hashed order. ``copy`` numbers repeated rows.
    """
    size = word_count(F.col("text"))
    sized = docs.select("doc_id", "source", size.alias("size"), document_key(size).alias("key"))
    sized = keep(_numbered(sized, "key", "copy", "source", "size"), "mix-sizes")
    named = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeat)
    named = keep(named.withColumn("source_id", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))), "mix-targets")
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = (
        sized.join(named.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
        .withColumn("digest", hash_hex(seed, identity, F.col("copy")))
        .withColumn("bucket", F.substring("digest", 1, DIGITS))
    )
    return _running(placed, ["source_id"], "bucket", ["digest", "key"], "size", "queued").drop("bucket")


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed=SEED) -> DataFrame:
    """One row per document row: doc_id, source, key, copy, size, source_size, target, passes, taken."""
    queued = keep(queue(docs, weights, max_repeat, seed), "mix-queue")
    budget = queued.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    turns = (
        queued.where("size > 0 AND target > 0")
        .select("key", "copy", "source_id", "digest", "size", "source_size", "target", "queued",
                F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))).alias("turn"))
        .withColumn("finish", (F.col("turn") * F.col("source_size") + F.col("queued")).cast("double") / F.col("target"))
        .withColumn("cell", _cell(F.col("finish")))
    )
    passes = (
        _running(turns, [], "cell", ["finish", "source_id", "turn", "digest", "key"], "size", "passed")
        .where(F.col("passed") <= budget).groupBy("key", "copy").agg(F.count("*").alias("passes"))
    )
    return (
        queued.join(passes, ["key", "copy"], "left").withColumn("passes", F.coalesce("passes", F.lit(0)))
        .select("doc_id", "source", "key", "copy", "size", "source_size", "target", "passes",
                (F.col("passes") * F.col("size")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed=SEED) -> DataFrame:
    """The documents of the mix with all their columns; one that is taken n times appears n times."""
    key, copy, turn = (with_fresh(docs, c) for c in ("_key", "_copy", "_turn"))
    of, number, passes = (with_fresh(docs, c) for c in ("_of", "_number", "_passes"))
    taken = mix(docs, weights, max_repeat, seed).where("passes > 0").select("key", "copy", "passes").toDF(of, number, passes)
    # Rows under one key are equal in text, source and size; without repeats the window sees one row.
    marked = _numbered(docs.withColumn(key, document_key(word_count(F.col("text")))), key, copy)
    return (
        marked.join(taken, (F.col(key) == F.col(of)) & (F.col(copy) == F.col(number)))
        .withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(passes).cast("int"))))
        .select(*docs.columns)
    )
